"""The registered queries opN_<name>: each applies its operator to its whole table and derives the digest columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.session import cut_lineage, ensure_checkpoint_dir, table

from . import bpe, chat, dedup, mixing, neardup, packing, pii, quality, secrets, toxicity, variants, warc, whitening
from .registry import register


@register("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [k.name for k in pii.KINDS if k.base]
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    of = lambda *names: F.filter("spans", lambda s: s["kind"].isin(*names))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(pii.span_text(of(*base)), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"))


@register("op3_chat")
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = spark.sql("""SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'),
        (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)""")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(fixed)
    done = chat.format_conversations(rows.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts")))
    read = done.select("conv_id", "segments", chat.read_turns(F.col("segments")).alias("turns"),
                       chat.loss_text(F.col("segments")).alias("loss"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.aggregate("segments", F.lit(0).cast("long"), lambda a, s: a + F.length(s["formatted"])).alias("formatted_chars"))


@register("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"))


@register("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.fit(docs, learnt))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [r.name for r in secrets.RULES if r.base]
    of = lambda *names: F.filter("spans", lambda s: s["kind"].isin(*names))
    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(secrets.span_text(of(*base)), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"))


OP7_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
     g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM t JOIN g USING (t)
"""


@register("op7_dedup", OP7_SQL)
def op7_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.decisions(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op2_warc")
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pw-warc-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # alone in its workers, it can keep more than the stage of the pipeline can
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), packing.PackConfig(cache_chunks=700_000))


@register("op8_neardup")
def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "class_id", "class_size", "kept")


@register("op11_mixing")
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    laid, sources = mixing.lay_out(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), text=False)
    laid = cut_lineage(laid)
    taken = mixing.mix(laid, sources).groupBy("src", "offset").agg(F.sum("length").alias("taken")) \
        .select(F.col("src").alias("t_src"), F.col("offset").alias("t_offset"), "taken")
    # documents without words share their offset with the next one
    same = (F.col("src") == F.col("t_src")) & (F.col("offset") == F.col("t_offset")) & (F.col("size") > 0)
    return laid.join(sources.select("src", "source_size", "target"), "src").join(taken, same, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


@register("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 8)


RUN = "[A-Za-z\\u00C0-\\u00FF]{6,}+"     # shorter runs give no word of six code points
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def run_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the contract's words; a null doc_id counts as an empty text."""
    run = F.translate("run", UPPER, LOWER)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")) \
        .select(run.alias("run"), F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run)).alias("h"))
    gone = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % 199 == 0, F.concat(F.col("run").substr(F.lit(1), gone), F.col("run").substr(gone + 2, F.length("run")))) \
        .otherwise(F.col("run"))
    return runs.groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n")).where("length(word) >= 6 AND n >= 5")


@register("op13_variants")
def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(cut_lineage(run_words(table(spark, sf_dir, "documents").select("doc_id", "text")))).select(
        "word", "form", "root", "n", "n_near", "form_n")
