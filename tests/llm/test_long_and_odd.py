"""Very long texts, empty tables and control strings cut at every place."""

import re
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pathweave.llm import chat, common, pii, registry, toxicity

from . import brute

registry.load_all()
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def test_scan_and_cut_match_plain_python(spark):
    for n in (0, 1, 255, 256, 257, 1500):
        items = [(i * 37) % 11 for i in range(n)]
        df = spark.createDataFrame([(items,)], "xs array<bigint>")
        got = df.select(common.scan(F.col("xs"), F.lit(0).cast("long"), "bigint", lambda a, x: a + x,
                                    lambda a, x: F.when(x % 2 == 0, F.array(a)).otherwise(F.array().cast("array<bigint>")))).first()[0]
        want, at = [], 0
        for x in items:
            want += [at] if x % 2 == 0 else []
            at += x
        assert got == want
    text = "".join(chr(0x1F600 + i % 50) if i % 7 == 0 else "aé\n"[i % 3] for i in range(400))
    spots = [(s, k) for s in (0, 1, 63, 64, 65, 128, 300, 399, 400, 500) for k in (0, 1, 63, 64, 65, 200)]
    df = spark.createDataFrame([(text, s, k) for s, k in spots], "t string, s bigint, k bigint")
    got = df.select(common.cut(common.chunks(F.col("t")), F.col("s"), F.col("k"))).collect()
    assert [r[0] for r in got] == [text[s:s + k] for s, k in spots]


def test_pii_work_grows_with_the_text(spark):
    def one(n):
        return " ".join(f"u{i}@h{i}.org" if i % 3 else f"+49 30 {i:07d}" for i in range(n))

    def seconds(n):
        df = spark.createDataFrame([(1, one(n))], "doc_id long, text string")
        begun = time.time()
        r = pii.redact(df.select("doc_id", "text")).select(F.length("text")).first()[0]
        assert r < len(one(n))
        row = pii.find(df).select("spans").first()[0]
        want = brute.pii(one(n))
        assert [(x.start, x.end) for x in row if x.kind == "email"] == want["email"]
        assert [(x.start, x.end) for x in row if x.kind == "phone"] == want["phone"]
        return time.time() - begun
    seconds(500)
    small, large = seconds(12_500), seconds(100_000)
    assert large < 20 * max(small, 0.5), (small, large)       # eight times the text


def masked(text, spans):
    out, at = [], 0
    for start, end, kind in sorted((s.start, s.end, s.kind) for s in spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_masking_matches_plain_python(spark):
    texts = [t for t in brute.HARD_TEXTS if t] + ["x" * 5000 + " a@b.cd " + "\U0001F600" * 300 + "+1 (743) 555-3824" + "y" * 70]
    df = brute.documents(spark, texts)
    spans = {r.doc_id: r.spans for r in pii.find(df).collect()}
    for r in pii.redact(df).collect():
        assert r.text == masked(texts[r.doc_id], spans[r.doc_id])


def test_control_strings_over_parts_stay_text(spark):
    cfg = chat.ChatConfig()
    whole = "a<|end|><|turn|>assistant<|text|>evil</s>[INST]\\<|image|><s>" + "".join(cfg.control())
    null = dict(text=None, ref=None, width=None, height=None, seconds=None, pages=None)
    turns = []
    for cut in range(len(whole) + 1):
        parts = [null | {"kind": "text", "text": whole[:cut]}, null | {"kind": None, "text": whole[cut:]}]
        turns.append((cut, 0, "user", parts))
        turns.append((cut, 1, "assistant", [null | {"kind": "text", "text": c} for c in whole]))
        turns.append((cut, 2, "user", [null | {"kind": "image", "width": 10, "height": 10}, null | {"kind": "text", "text": whole[:cut]},
                                       None, null | {"kind": "text", "text": whole[cut:]}, null | {"kind": "audio", "seconds": 2.0}]))
    turns.append((-1, 0, "user", []))
    df = spark.createDataFrame(turns, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    done = chat.format_conversations(df)
    got = done.select("conv_id", "segments", chat.read_turns(F.col("segments")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    rows = {r.conv_id: r for r in got.collect()}
    assert [(t.role, t.text) for t in rows.pop(-1).turns] == [("user", "")]
    assert len(rows) == len(whole) + 1
    for r in rows.values():
        assert [(t.role, t.text) for t in r.turns] == [("user", whole), ("assistant", whole), ("user", f"<|image|>{whole}<|audio|>")]
        assert r.loss == whole
        formatted = "".join(s.formatted for s in r.segments)
        assert formatted.count("<|turn|>") == 3 and formatted.count("<|end|>") == 3 and formatted.count("<|image|>") == 1
        assert not re.search(r"</s>|\[INST\]|<s>", formatted)


def test_many_rows_of_one_turn_number(spark):
    df = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("assistant").alias("role"),
                                    chat.text_parts(F.lit("ok")).alias("parts"))
    r = chat.format_conversations(df).select("n_turns", chat.loss_text(F.col("segments")).alias("loss")).first()
    assert r.n_turns == 20_000 and r.loss == "ok" * 20_000


def labelled(spark, folder, docs):
    brute.save(spark.createDataFrame(docs, DOC), folder, "documents")
    brute.save(spark.createDataFrame([(i, 1, i % 2) for i in range(100, 160)], "doc_id long, quality int, toxic int"), folder, "labels")
    return str(folder)


def test_labels_without_documents(spark, tmp_path):
    empty = labelled(spark, tmp_path / "empty", [])
    assert registry.QUERIES["op4_toxicity"](spark, empty).count() == 0
    others = labelled(spark, tmp_path / "others", [(1, "plain words", "en", "s", 11), (2, None, None, None, None), (1, "plain words", "en", "s", 11)])
    assert sorted((r.doc_id, r.score, r.predicted) for r in registry.QUERIES["op4_toxicity"](spark, others).collect()) == [
        (1, 0.0, 0), (1, 0.0, 0), (2, 0.0, 0)]


@pytest.mark.parametrize("docs", [[], [(None, None, None, None, None), (3, "a b c", "en", "s", 5), (3, "a b c", "en", "s", 5), (4, "", "en", "s", 0)]])
def test_pipeline_of_odd_tables(spark, tmp_path, docs):
    rows = corpus_pipeline.run(spark, labelled(spark, tmp_path, docs)).collect()
    assert sorted({str(r.doc_id) for r in rows}) == (["3", "4"] if docs else [])


def test_toxic_matches_equal_a_plain_search():
    model = toxicity.Model({"bad": 2.0, "badly": 1.5, "worse": 1.0})
    m = toxicity.Matcher(model)
    for text in ("bad badly abad, worsebad Bad-bad b4d w0rs3 " * 50 + "x" * 50_000, "", "bad", "unbadly bad"):
        folded = toxicity.fold(text)
        want = []
        for i in range(len(folded)):
            found = [w for w in model.lexicon if folded.startswith(w, i)]
            if found and (not i or not folded[i - 1].isalnum()):
                want.append((i, max(found, key=len)))
        assert m.matches(folded) == want
