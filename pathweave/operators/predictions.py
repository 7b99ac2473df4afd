"""Post-processing of model predictions (K1, K2, G6, D7) and corpus BLEU (F8).

Attention table (one row per attention weight)::

    method, step, word, context, score

``step`` is the place of the word among a method's suggestions, so a word that
is suggested twice has two maps.  ``attention_steps`` makes the table from
nested results.

Scale notes: the attention map is a partial aggregate per (method, step,
context); top-k per (method, step) is ``row_number() <= k`` (partial
``WindowGroupLimit``); path information is an equi-join.  BLEU counts n-grams
per (pair, n, gram) with partial aggregates and clips them with an equi-join,
so nothing is collected per corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tokens import is_legal_name


def suggested_words(results: DataFrame) -> DataFrame:
    """(method, step, word) of the legal words of nested results, as far as they have an attention map.

    ``results``: method, words array<string>, attention array<map<string,double>>
    (one map per word; the shorter of the two arrays counts).
    """
    return _steps(results).where(is_legal_name("word")).select("method", "step", "word")


def attention_steps(results: DataFrame) -> DataFrame:
    """The attention table of nested results (see ``suggested_words``)."""
    return _steps(results).select("method", "step", "word", F.explode("weights").alias("context", "score"))


def _steps(results: DataFrame) -> DataFrame:
    both = F.slice(F.arrays_zip(F.col("words").alias("word"), F.col("attention").alias("weights")), 1,
                   F.least(F.size("words"), F.size("attention")))
    return results.select("method", F.posexplode(both).alias("step", "s")).select(
        "method", F.col("step").cast("bigint").alias("step"), "s.word", "s.weights")


def attention_map(att: DataFrame) -> DataFrame:
    """One weight per (method, step, context): a map keeps one value per key (the largest here)."""
    return att.groupBy("method", "step", "word", "context").agg(F.max("score").alias("score"))


def attention_topk(att: DataFrame, k: int) -> DataFrame:
    """Top ``k`` contexts by weight per predicted step (ties by context); illegal words dropped."""
    legal = attention_map(att.where(is_legal_name("word")))
    w = Window.partitionBy("method", "step").orderBy(F.col("score").desc(), F.col("context"))
    return legal.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def attention_paths(topk: DataFrame, path_info: DataFrame) -> DataFrame:
    """Keep the top contexts that have path information (so fewer than k may remain)."""
    return topk.join(path_info, "context")


def parse_predictions(topk_paths: DataFrame, words: DataFrame, methods: DataFrame) -> DataFrame:
    """Per method and step: the predicted word and its attention paths.

    ``words``: method, step, word (legal words only, in suggestion order);
    ``methods``: method, method_id, original_name.  A method without a legal
    word keeps one row whose step and word are null.
    """
    per_step = (topk_paths.groupBy("method", "step")
                .agg(F.array_sort(F.collect_list(F.struct("rank", "score", "path", "token1", "token2"))).alias("paths")))
    return (methods.join(words.join(per_step, ["method", "step"], "left"), "method", "left")
            .select("method_id", "original_name", "step", "word",
                    F.coalesce("paths", F.array().cast("array<struct<rank:int,score:double,path:string,"
                                                       "token1:string,token2:string>>")).alias("paths")))


def filter_sequences(seqs, col: str = "words"):
    """No attention: drop the special names from each suggested sequence."""
    return F.filter(F.col(col), is_legal_name)


# ---------------------------------------------------------------------- BLEU
def _ngrams(words, max_n: int):
    empty = F.array().cast("array<struct<n:int,gram:string>>")
    return F.flatten(F.transform(F.sequence(F.lit(1), F.lit(max_n)), lambda n: F.when(
        F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1),
                                        lambda i: F.struct(n.alias("n"), F.array_join(F.slice(words, i, n), " ")
                                                           .alias("gram")))).otherwise(empty)))


def _ngram_counts(df: DataFrame, col: str, max_n: int) -> DataFrame:
    g = df.select("pair_id", F.explode(_ngrams(F.col(col), max_n)).alias("g"))
    return g.groupBy("pair_id", F.col("g.n").alias("n"), F.col("g.gram").alias("gram")).agg(F.count("*").alias("c"))


def corpus_bleu(pairs: DataFrame, max_n: int = 4) -> DataFrame:
    """Corpus BLEU (Papineni et al., 2002) of ``hyp`` against one ``ref`` per pair.

    ``pairs``: pair_id, ref array<string>, hyp array<string>.  One output row:
    bleu (0..100), bp, p1..p4 (precisions in %), hyp_len, ref_len.
    """
    h = _ngram_counts(pairs, "hyp", max_n)
    r = _ngram_counts(pairs, "ref", max_n).withColumnRenamed("c", "rc")
    clipped = (h.join(r, ["pair_id", "n", "gram"], "left")
               .select("n", "c", F.least("c", F.coalesce("rc", F.lit(0))).alias("m")))
    lens = pairs.agg(F.sum(F.size("hyp")).alias("hyp_len"), F.sum(F.size("ref")).alias("ref_len"))
    per_n = clipped.unionByName(lens, allowMissingColumns=True).groupBy().agg(
                                  *[F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(x) for x in ("hyp_len", "ref_len")],
                                  *[F.sum(F.when(F.col("n") == i, F.col("m")).otherwise(0)).alias(f"m{i}")
                                   for i in range(1, max_n + 1)],
                                  *[F.sum(F.when(F.col("n") == i, F.col("c")).otherwise(0)).alias(f"t{i}")
                                    for i in range(1, max_n + 1)])
    prec = [F.when(F.col(f"t{i}") > 0, F.col(f"m{i}") / F.col(f"t{i}")).otherwise(F.lit(0.0)) for i in range(1, max_n + 1)]
    logsum = sum((F.log(p) for p in prec[1:]), F.log(prec[0]))
    hyp_len, ref_len = F.col("hyp_len"), F.col("ref_len")
    bp_col = F.when((hyp_len >= ref_len) | (hyp_len == 0), 1.0).otherwise(F.exp(1.0 - ref_len / hyp_len))
    any_zero = F.lit(False)
    for p in prec:
        any_zero = any_zero | (p <= 0)
    bleu = F.when(any_zero, F.lit(0.0)).otherwise(bp_col * F.exp(logsum / max_n) * 100)
    return per_n.select(bleu.alias("bleu"), bp_col.cast("double").alias("bp"),
                      *[(p * 100).alias(f"p{i + 1}") for i, p in enumerate(prec)],
                      "hyp_len", "ref_len")
