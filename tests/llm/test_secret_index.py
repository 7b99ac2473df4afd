"""The secret scan's index against plain Python: postings, segments and the rows left to verify."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from pathweave.llm import secrets


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abAé\U0001F600\x00 ", max_size=12), max_size=8))
def test_postings_are_those_of_every_trigram(texts):
    index = secrets.SegmentIndex([t.lower() for t in texts])
    have = {}
    for i, t in enumerate(texts):
        for g in {t.lower()[j:j + 3] for j in range(len(t.lower()) - 2)}:
            have.setdefault(g, []).append(i)
    assert {g: index[g].tolist() for g in have} == have
    assert index["zzz"].tolist() == [] and len(set(index.trigrams.tolist())) == len(have)


def test_blocks_of_a_long_text_lose_no_trigram(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh") for _ in range(5000))
    whole = secrets.text_trigrams(text)
    for block in (1, 2, 3, 999, 4998, 4999, 5000):
        monkeypatch.setattr(secrets, "BLOCK_CHARS", block)
        assert (secrets.text_trigrams(text) == whole).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=30), st.integers(1, 5), st.integers(1, 20))
def test_segments_cover_every_row_once(sizes, rows, chars):
    parts = list(secrets.segments(sizes, rows, chars))
    assert [i for a, b in parts for i in range(a, b)] == list(range(len(sizes)))
    assert all(b - a <= rows and (b - a == 1 or sum(sizes[a:b]) <= chars) for a, b in parts)


def test_only_candidates_are_verified():
    """Rows that answer a rule's query are few among rows without its trigrams, and none with a match is left out."""
    rng = random.Random(7)
    texts = ["".join(rng.choice("bcdfgh ") for _ in range(200)) for _ in range(400)]
    for i in range(0, 400, 50):
        texts[i] += " AKIA" + "Q" * 16
    texts[7] += " aki and kia apart"        # a candidate without a match
    index = secrets.SegmentIndex([t.lower() for t in texts])
    rule = next(r for r in secrets.RULES if r.name == "access")
    rows = secrets.answer(secrets.trigram_query(rule.pattern), index, len(texts))
    assert sorted(rows.tolist()) == sorted([*range(0, 400, 50), 7])


def test_segment_sizes_change_nothing(spark):
    texts = [None, "", "ab", "token=abcdef1", "x" * 3000 + " password: hunter22", "AKIA" + "Z" * 16] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    want = sorted(map(str, secrets.scan(docs).collect()))
    for rows, chars in ((1, 10), (3, 50), (1000, 10**9)):
        assert sorted(map(str, secrets.scan(docs, segment_rows=rows, segment_chars=chars).collect())) == want
    assert secrets.scan(docs.limit(0)).count() == 0
