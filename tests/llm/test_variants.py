"""Spelling variants against a brute-force comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from pathweave.llm import registry, variants

from . import brute

registry.load_all()


def near(a, b):
    """Exactly one inserted, deleted or replaced code point apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(counts, ratio=5):
    out, forms = {}, {}
    for w, n in counts.items():
        around = [x for x in counts if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = (forms[w], n, len(around), counts[forms[w]] if forms[w] else None)
    for w in out:
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (out[w][0], root, *out[w][1:])
    return out


def contract_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def result(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query_matches_brute_force_on_whole_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = grouped(contract_words(rows))
    got = registry.QUERIES["op13_variants"](spark, sf).collect()
    assert len(got) == len(want) and result(got) == want
    assert any(v[0] for v in want.values())


def test_hard_texts(spark, tmp_path):
    deleted = next(i for i in range(10000) if zlib.crc32(f"{i}:spelling".encode()) % 199 == 0)
    rows = [(deleted, "Spelling SPELLING spelling spelling spelling"), (1, " spelling" * 99), (2, "spelling_spelling9étésétés " * 6),
            (2, "spelling_spelling9étésétés " * 6), (None, "nameless " * 7), (3, None), (4, ""), (5, "ÉTÉSétés " * 9),
            (6, "İstanbul Ÿpres fifteen " * 5), (7, "fiftee fifteenx xfifteen " * 30),
            (8, ("a" * 3000 + " ") * 6), (9, ("a" * 1500 + "b" + "a" * 1499 + " ") * 40), (10, ("a" * 2999 + " ") * 5), (11, "a" * 20000)]
    brute.save(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS word"), tmp_path, "documents")
    want = grouped(contract_words(rows))
    got = result(registry.QUERIES["op13_variants"](spark, str(tmp_path)).collect())
    assert got == want
    assert want["a" * 3000][0] == "a" * 1500 + "b" + "a" * 1499


def test_empty_table(spark, tmp_path):
    brute.save(spark.createDataFrame([], "doc_id long, text string"), tmp_path, "documents")
    assert registry.QUERIES["op13_variants"](spark, str(tmp_path)).count() == 0
    assert variants.group(spark.createDataFrame([(None, 4)], "word string, n long")).count() == 0


@pytest.mark.parametrize("seed,letters,least,most", [(1, "ab", 1, 7), (2, "abc", 1, 6), (3, "abcdefgh", 2, 9)])
def test_dense_vocabularies(spark, seed, letters, least, most):
    rng = random.Random(seed)
    counts = {"".join(rng.choice(letters) for _ in range(rng.randint(least, most))): rng.choice([1, 2, 5, 10, 60, 400, None])
              for _ in range(350)}
    if seed == 3:     # a third of the words share a long prefix
        counts |= {"prefixprefix" + "".join(rng.choice(letters) for _ in range(rng.randint(0, 3))): rng.randint(1, 99) for _ in range(170)}
    table = spark.createDataFrame([(w, n, 1) for w, n in counts.items()], "word string, n long, form int")
    got = result(variants.group(table, variants.VariantConfig(salt_words=50)).collect())
    assert got == grouped({w: n or 0 for w, n in counts.items()})


def test_repeated_words_add_up(spark):
    rows = spark.createDataFrame([("colour", 3), ("colour", 2), ("color", 50), (None, 5)], "word string, n long")
    assert result(variants.group(rows).collect()) == {"colour": ("color", "color", 5, 1, 50), "color": (None, "color", 50, 1, None)}
