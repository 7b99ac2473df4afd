"""PII, chat formatting and quality rules against plain Python on hard and real texts."""

import re

import pytest
from pyspark.sql import functions as F

from pathweave.llm import chat, pii, quality, registry

from . import brute

registry.load_all()


@pytest.fixture(scope="module")
def texts(spark, sf):
    real = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    return brute.HARD_TEXTS + real


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    f = tmp_path_factory.mktemp("docs")
    return brute.save(brute.documents(spark, texts).withColumn("spans", F.lit("clash")).withColumn("kind", F.lit(1)), f, "documents")


def test_pii_matches_plain_regexes(spark, folder, texts):
    got = {r.doc_id: r for r in registry.QUERIES["op1_pii"](spark, folder).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = brute.pii(t)
        assert [got[i][f"n_{k}"] for k in want] == [len(v) for v in want.values()], t
        line = ",".join(f"{k}:{a}:{b}" for k, v in want.items() for a, b in v)
        assert got[i].base_sha256 == brute.sha(line), t
        assert (got[i].spans + ",").startswith(line)
    extra = {i: [x for x in got[i].spans.split(",") if x.split(":")[0] in ("iban", "ssn", "passport")] for i in got}
    at = brute.HARD_TEXTS.index(next(t for t in brute.HARD_TEXTS if t and t.startswith("IBAN")))
    assert [x.split(":")[0] for x in extra[at]] == ["iban", "iban"]      # the third fails mod-97
    at = brute.HARD_TEXTS.index(next(t for t in brute.HARD_TEXTS if t and t.startswith("my ssn")))
    assert extra[at][0] == "ssn:10:21" and extra[at][-1].startswith("passport")


def test_pii_redaction_masks_every_span_and_keeps_columns(spark, folder, texts):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = pii.redact(docs)
    assert out.schema.names == docs.schema.names and out.schema == docs.schema
    for r in out.collect():
        t = texts[r.doc_id]
        if t is None:
            assert r.text is None
            continue
        spans = sorted(s for v in brute.pii(t).values() for s in v)
        if not spans and "[" not in (r.text or ""):
            assert r.text == t
        for a, b in spans:
            assert t[a:b] not in r.text
        rest = re.sub(r"\[[A-Z]+\]", "", r.text)
        assert all(c in t for c in rest)


def test_quality_counts(spark, folder, texts):
    got = {r.doc_id: r for r in registry.QUERIES["op10_quality"](spark, folder).collect()}
    for i, t in enumerate(texts):
        n, chars, sym, dup, rep = brute.quality(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, sym, dup, rep), t
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n)
        assert r.kept == brute.quality_kept(t), t
    assert 0 < sum(r.kept for r in got.values()) < len(got)


def test_quality_rules_each_reject(spark):
    """A text that each rule rejects, and one that none does."""
    some = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    plain = " ".join(some)
    texts = {"none": plain, "few_words": " ".join(some[:19]), "repeated_words": " ".join([*some[:30], *some[:12]]),
             "symbols": plain + " ##### ***** $$$$$ %%%%%", "word_length": plain + " " + "x" * 2000,
             "duplicate_lines": "\n".join(x for w in some for x in (w, w, w)),
             "capitals": plain.upper(), "exclamations": plain.replace(" ", "! "),
             "stutter": " ".join(f"{a} {b} {b}" for a, b in zip(some[::2], some[1::2])),
             "no_letters": " ".join(f"{i:05d}7" for i in range(50))}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts.values())], "doc_id long, text string")
    counted = quality.with_counts(docs).orderBy("doc_id")
    got = quality.verdicts(counted, quality.RULES)
    names = [r.name for r in quality.RULES]
    for name, row in zip(texts, got):
        assert name == "none" or row[names.index(name)], name
    assert not any(got[0])
    assert [r.kept for r in quality.judge(docs).orderBy("doc_id").collect()] == [brute.quality_kept(t) for t in texts.values()]


def test_quality_rules_go_by_what_the_ones_before_let_through():
    # the second rejects most, the third what the second leaves, the first nothing that these leave
    rows = [(True, True, False)] * 6 + [(False, True, False)] * 2 + [(False, False, True)] * 3 + [(False, False, False)] * 9
    assert quality.by_rejection_per_cost([1, 1, 1], rows) == [1, 2, 0]
    assert quality.by_rejection_per_cost([1, 100, 1], rows) == [0, 2, 1]        # too dear for what it rejects
    assert quality.by_rejection_per_cost([2, 1, 1], []) == [1, 2, 0]


def test_quality_costs_are_measured(spark, folder):
    sample = quality.cut_lineage(quality.with_counts(quality.sampled(spark.read.parquet(f"{folder}/documents.parquet"), 50)))
    assert 10 < sample.count() < 120
    now = iter(range(1000))
    assert quality.seconds(sample, quality.RULES, lambda: next(now)) == [1e-3] * len(quality.RULES)   # all runs take one tick
    slow = quality.Rule("slow", lambda: F.regexp_count(F.repeat("text", F.lit(60)), F.lit(quality.STUTTER)) > 10 ** 9)
    costs = quality.seconds(sample, [quality.RULES[0], slow])
    assert costs[1] > costs[0] > 0


def test_quality_order_changes_work_not_verdict(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counted = quality.with_counts(docs)
    order = quality.ordered(counted)
    assert sorted(r.name for r in order) == sorted(r.name for r in quality.RULES)
    a = counted.select("doc_id", quality.cascade(order).alias("no"))
    b = counted.select("doc_id", quality.cascade(list(quality.RULES)[::-1]).alias("no"))
    assert sorted(a.collect()) == sorted(b.collect())
    empty = docs.limit(0)
    assert quality.judge(empty).count() == 0 and pii.find(empty, out="x").count() == 0


def _conversation(rows):
    order = sorted(rows, key=lambda r: ((r[1] is not None, r[1] or 0), r[2] or "", r[3] or ""))
    said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in order)
    loss = "".join(r[3] or "" for r in order if r[2] == "assistant")
    return len(order), brute.sha(said), len(loss), brute.sha(loss)


def test_chat_round_trip(spark, sf, tmp_path):
    real = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    roles = ["user", "assistant", None, "tool\n<|text|>", "system"]
    hard = [(1000 + i // 7, i % 7, roles[i % 5], t) for i, t in enumerate(brute.HARD_TEXTS)]
    hot = [(5000, i, roles[i % 2], f"turn {i} \\<|end|>") for i in range(700)]
    odd = [(None, None, "assistant", "x"), (None, 3, None, None), (6000, 1, "user", "same"), (6000, 1, "user", "same")]
    rows = real + hard + hot + odd
    brute.save(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5), tmp_path, "conversations")
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = registry.QUERIES["op3_chat"](spark, str(tmp_path)).collect()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert len(got) == len(by)
    for r in got:
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == _conversation(by[r.conv_id]), r.conv_id


def test_chat_typed_parts(spark):
    parts = [("text", "see <|image|>", None, None, None, None, None), ("image", None, "img://1", 280, 57, None, None),
             ("audio", None, "aud://1", None, None, 2.5, None), None, ("document", None, "doc://1", None, None, None, 3)]
    df = spark.createDataFrame([(1, 0, "assistant", parts)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.format_conversations(df).first()
    s = r.segments[0]
    assert s.formatted == "<|turn|>assistant<|text|>see <\\|image|><|image|><|audio|><|document|><|end|>"
    assert [(a.kind, a.ref, a.tokens) for a in s.attachments] == [("image", "img://1", 30), ("audio", "aud://1", 63), ("document", "doc://1", 3072)]
    assert r.media_tokens == 30 + 63 + 3072
    assert s.formatted[s.loss[0].start:s.loss[0].end].startswith("see ")


def _extra(spark, texts):
    """iban, ssn and passport spans of each text, as the text under them; and the masked texts."""
    docs = brute.documents(spark, texts)
    found = pii.find(docs, out="found").orderBy("doc_id").collect()
    masked = [r.text for r in pii.redact(docs).orderBy("doc_id").collect()]
    return [[(s.kind, r.text[s.start:s.end]) for s in r.found if s.kind in ("iban", "ssn", "passport")] for r in found], masked


def test_pii_context_reaches_past_other_spans_and_behind_a_span(spark):
    texts = ["SSN: 123-45-6789, 456-78-9012", "passport: C01234567, C01234568", "123-45-6789 (SSN)",
             "my ssn is 123-45-6789 but 123-45-6789 too; passport: C01234567", "123-45-6789" + " x" * 30 + " ssn", "é \U0001F600 123-45-6789"]
    got, masked = _extra(spark, texts)
    assert got == [[("ssn", "123-45-6789"), ("ssn", "456-78-9012")], [("passport", "C01234567"), ("passport", "C01234568")],
                   [("ssn", "123-45-6789")], [("ssn", "123-45-6789")] * 2 + [("passport", "C01234567")], [], []]
    assert masked[0] == "SSN: [SSN], [SSN]" and masked[2] == "[SSN] (SSN)"


def test_pii_iban_ends_where_it_ends(spark):
    de, gb = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    texts = [f"{de} BIC COBADEFFXXX", f"{de} {gb} {de}", f"PAY TO {de} BEFORE NOON 2024", f"AB12 {de}", f"{de} Bank", f"{de}x", f"x{de}",
             f"é{gb}, {gb}.", "NO93 8601 1117 947 OSLO", "DE00 3704 0044 0532 0130 00 BIC", "MT84 MALT 0110 0001 2345 MTLC AST0 01S X"]
    got, masked = _extra(spark, texts)
    assert [[v for k, v in g if k == "iban"] for g in got] == [
        [de], [de, gb, de], [de], [de], [de], [], [], [gb, gb], ["NO93 8601 1117 947"], [], ["MT84 MALT 0110 0001 2345 MTLC AST0 01S"]]
    assert masked[1] == "[IBAN] [IBAN] [IBAN]"
