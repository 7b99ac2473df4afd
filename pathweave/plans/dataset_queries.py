"""Registered merge / preprocess queries over the mined order-tree samples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import DatasetConfig
from ..functions.text import format_sample, raw_line
from ..functions.tokens import PAD, UNK
from ..operators import dataset as D
from ..operators import tree as T
from ..operators import vocab as V
from ..session import ensure_checkpoint_dir, table
from ..sources.c2s import first_raw_samples, parse_dataset_lines, read_raw_samples
from .registry import register
from .sql_ot import ot_pairs_sql, tok_sql
from .tree_queries import ot_leaf_samples, ot_samples

DEFAULT = DatasetConfig()
ROW = "_row"  # stored id of a sample
SMALL = DatasetConfig(max_contexts=10, max_data_contexts=20, subtoken_vocab_size=50, target_vocab_size=10)


def _sql_split(ratio: float = 0.7) -> str:
    tr = f"CAST(floor(n * {ratio}) AS BIGINT)"
    te = f"(n - {tr}) // 2"
    return (f"CASE WHEN sample_id < {tr} THEN 'train' WHEN sample_id < {tr} + {te} THEN 'test' "
            f"ELSE 'val' END")


BASE_SQL = f"""WITH {ot_pairs_sql('random', 100)},
ctx AS (SELECT *, start_tok || ',' || path || ',' || end_tok AS c FROM ot_ctx),
smp AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS file, o.o_orderkey AS line, g.tree_id, g.n_contexts, g.ctxs,
         array_to_string({tok_sql('o.o_orderpriority')}, '|') AS target
  FROM (SELECT tree_id, count(*) AS n_contexts, string_agg(c, ' ' ORDER BY pair_idx) AS ctxs
        FROM ctx GROUP BY tree_id) g JOIN orders o ON o.o_orderkey = g.tree_id
),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || file || ':' || line), file, line) - 1 AS sample_id,
         count(*) OVER () AS n
  FROM smp
),
dataset AS (SELECT * FROM (SELECT *, {_sql_split()} AS split FROM ranked) WHERE split IS NOT NULL),
train_ctx AS (SELECT ctx.* FROM ctx JOIN dataset d ON d.tree_id = ctx.tree_id WHERE d.split = 'train')"""

HIST_SQL = BASE_SQL + """,
hist AS (
  SELECT 'target' AS kind, t AS token, count(*) AS cnt
    FROM (SELECT unnest(string_split(target, '|')) AS t FROM dataset WHERE split = 'train') GROUP BY t
  UNION ALL
  SELECT 'subtoken', t, count(*) FROM (
    SELECT unnest(string_split(start_tok, '|')) AS t FROM train_ctx
    UNION ALL SELECT unnest(string_split(end_tok, '|')) FROM train_ctx) GROUP BY t
  UNION ALL
  SELECT 'node', t, count(*) FROM (
    SELECT unnest(CASE WHEN path = '' THEN []::VARCHAR[] ELSE string_split(path, '|') END) AS t FROM train_ctx) GROUP BY t
),
vocab AS (
  SELECT *, row_number() OVER (PARTITION BY kind ORDER BY cnt DESC, token) - 1 AS pos FROM hist
)"""


def ot_dataset(spark, sf, cfg: DatasetConfig = DEFAULT, columns: list | None = None):
    """The split samples, whose leaves stay where they were written and give the contexts; with ``columns`` only these are written, and ranked."""
    if columns is not None:
        samples, _ = ot_samples(spark, sf)
        return D.shuffle_split(V.materialize(samples.select(*columns)), cfg)
    samples, _ = ot_leaf_samples(spark, sf)
    samples = V.materialize(samples.withColumn(ROW, F.monotonically_increasing_id()))
    return D.shuffle_split_in_place(samples, cfg, ROW).drop(ROW)


def train_vocab(spark, sf, cfg: DatasetConfig = DEFAULT):
    """The split samples and the vocabulary, which is written so that the planner knows its size."""
    ds = ot_dataset(spark, sf, cfg)
    hist = V.histograms(ds.where(F.col("split") == "train"))
    sizes = {"subtoken": cfg.subtoken_vocab_size, "target": cfg.target_vocab_size, "node": cfg.node_vocab_size}
    return ds, V.materialize(V.vocab_top_n(hist, sizes))


# ----------------------------------------------------------------- G1 / H3 / G2
@register("sample_ids", BASE_SQL + "\nSELECT file, line, sample_id FROM ranked")
def q_sample_ids(spark, sf):
    samples, _ = ot_samples(spark, sf)
    return D.hash_rank(V.materialize(samples.select("file", "line")), ["file", "line"], DEFAULT.seed).select("file", "line", "sample_id")


@register("shuffle_split", BASE_SQL + "\nSELECT file, line, split FROM dataset")
def q_shuffle_split(spark, sf):
    return ot_dataset(spark, sf, columns=["file", "line"]).select("file", "line", "split")


@register("global_shuffle", BASE_SQL + "\nSELECT sample_id, target || ' ' || ctxs AS text FROM dataset")
def q_global_shuffle(spark, sf):
    samples, _ = ot_leaf_samples(spark, sf)
    # the text is a fraction of the nested contexts that it is made of, so the shuffles carry the text
    texts = V.materialize(T.with_texts(samples).select("file", "line", format_sample("target", "contexts", texts=True).alias("text")))
    return D.shuffle_split(texts, DEFAULT).orderBy("sample_id").select("sample_id", "text")


# ----------------------------------------------------------------- D8 / I1 / A5
DEDUP_SQL = """SELECT CAST(l_orderkey AS VARCHAR) AS file, CAST(l_linenumber AS BIGINT) AS line,
       l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                                            l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
      FROM lineitem) WHERE rn = 1"""


@register("dedup_source_mark", DEDUP_SQL)
def q_dedup_source_mark(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("file"), F.col("l_linenumber").cast("bigint").alias("line"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus", "l_shipdate")
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
             "l_linestatus", "l_shipdate"]
    return D.dedup_first_stored(li, ["file", "line"], order).select(
        "file", "line", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


MERGE_SQL = f"""WITH {ot_pairs_sql('random', 100)},
g AS (SELECT tree_id, string_agg(start_tok || ',' || path || ',' || end_tok, ' ' ORDER BY pair_idx) AS ctxs
      FROM ot_ctx GROUP BY tree_id)
SELECT o.o_orderstatus AS raw_file, CAST(o.o_custkey AS VARCHAR) AS file, o.o_orderkey AS line,
       array_to_string({tok_sql('o.o_orderpriority')}, '|') || ' ' || g.ctxs AS sample
FROM g JOIN orders o ON o.o_orderkey = g.tree_id"""


def _raw_parts(spark, sf):
    """Two folders of raw text files as separate miners write them, with the order status in their paths."""
    samples, _ = ot_leaf_samples(spark, sf)
    status = table(spark, sf, "orders").select(F.col("o_orderkey").alias("tree_id"),
                                               F.col("o_orderstatus").alias("raw_file"))
    part = F.pmod(F.xxhash64("raw_file"), F.lit(2))      # every status, null too, is in one of them
    lines = T.with_texts(samples.join(status, "tree_id")).select(
        part.alias("part"), "raw_file", raw_line("file", "line", "target", "contexts", texts=True).alias("value"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pw-raw-{uuid.uuid4().hex}"
    folders = [f"{folder}/part={i}" for i in (0, 1)]
    for f in folders:                                   # also a folder that gets no line
        spark.createDataFrame([], "value string").write.text(f)
    lines.write.mode("append").partitionBy("part", "raw_file").option("compression", "gzip").text(folder)
    return folders


@register("merge_raw", MERGE_SQL)
def q_merge_raw(spark, sf):
    merged = D.merge_raw(*[read_raw_samples(spark, p) for p in _raw_parts(spark, sf)])
    name = F.regexp_extract("source", "/raw_file=([^/]*)/", 1)
    return merged.select(F.when(name != "__HIVE_DEFAULT_PARTITION__", name).alias("raw_file"), "file", "line", "sample")


@register("raw_parse", MERGE_SQL.replace("SELECT o.o_orderstatus AS raw_file, ", "SELECT "))
def q_raw_parse(spark, sf):
    return first_raw_samples(read_raw_samples(spark, *_raw_parts(spark, sf))).select("file", "line", "sample")


# ----------------------------------------------------------------- F1-F3 / H1 / F7
@register("hist_target", HIST_SQL + "\nSELECT token, cnt FROM hist WHERE kind = 'target'")
def q_hist_target(spark, sf):
    ds = ot_dataset(spark, sf, columns=["file", "line", "target"]).where(F.col("split") == "train")
    return V.histograms(ds, ("target",)).select("token", "cnt")


@register("hist_subtoken", HIST_SQL + "\nSELECT token, cnt FROM hist WHERE kind = 'subtoken'")
def q_hist_subtoken(spark, sf):
    ds = ot_dataset(spark, sf).where(F.col("split") == "train")
    return V.histograms(ds, ("subtoken",)).select("token", "cnt")


@register("hist_node", HIST_SQL + "\nSELECT token, cnt FROM hist WHERE kind = 'node'")
def q_hist_node(spark, sf):
    ds = ot_dataset(spark, sf).where(F.col("split") == "train")
    return V.histograms(ds, ("node",)).select("token", "cnt")


@register("vocab_top_n", HIST_SQL + """
SELECT kind, token, cnt, pos FROM vocab
WHERE (kind = 'subtoken' AND pos < 50) OR (kind = 'target' AND pos < 10) OR kind = 'node'""")
def q_vocab_top_n(spark, sf):
    _, vocab = train_vocab(spark, sf, SMALL)
    return vocab.select("kind", "token", "cnt", "pos")


@register("vocab_sizes", HIST_SQL + "\nSELECT kind, count(*) AS size FROM vocab GROUP BY kind")
def q_vocab_sizes(spark, sf):
    _, vocab = train_vocab(spark, sf)
    return V.vocab_sizes(vocab)


def _index_sql(specials: list[str]) -> str:
    sp = " UNION ALL ".join(f"SELECT k.kind, '{s}' AS token, {i}::BIGINT AS idx FROM (SELECT DISTINCT kind FROM "
                            f"(VALUES ('target'), ('subtoken'), ('node')) v(kind)) k" for i, s in enumerate(specials))
    return HIST_SQL + f""",
allidx AS ({sp} UNION ALL SELECT kind, token, pos + {len(specials)} FROM vocab)
SELECT a.kind, a.token, a.idx, f.word_idx FROM allidx a
JOIN (SELECT kind, token, max(idx) AS word_idx FROM allidx GROUP BY kind, token) f
  ON f.kind = a.kind AND f.token = a.token"""


@register("vocab_index", _index_sql([PAD, UNK]))
def q_vocab_index(spark, sf):
    _, vocab = train_vocab(spark, sf)
    return V.vocab_index(vocab, [PAD, UNK]).select("kind", "token", "idx", "word_idx")


SPECIALS_WITH_CLASH = [PAD, UNK, "MEDIUM", "ORDER"]


@register("specials_union", _index_sql(SPECIALS_WITH_CLASH))
def q_specials_union(spark, sf):
    _, vocab = train_vocab(spark, sf)
    return V.vocab_index(vocab, SPECIALS_WITH_CLASH).select("kind", "token", "idx", "word_idx")


# ----------------------------------------------------------------- G3 / J6 / F4 / F5 / A7 / A10
SAMPLED_SQL = BASE_SQL + """,
lim AS (SELECT tree_id, file, line, split, target, n_contexts,
               CASE WHEN split = 'train' THEN {train} ELSE {other} END AS lim FROM dataset),
ex AS (
  SELECT l.*, c.pair_idx, c.c,
         row_number() OVER (PARTITION BY l.tree_id ORDER BY md5('42:' || l.file || ':' || l.line || ':' ||
                            c.pair_idx)) AS hk
  FROM lim l JOIN ctx c ON c.tree_id = l.tree_id
),
sampled AS (
  SELECT tree_id, file, line, split, target, any_value(n_contexts) AS n_before,
         count(*) AS n_after,
         string_agg(c, ' ' ORDER BY CASE WHEN n_contexts > lim THEN hk ELSE pair_idx END) AS ctxs
  FROM ex WHERE n_contexts <= lim OR hk <= lim
  GROUP BY tree_id, file, line, split, target
)"""


def _sampled(spark, sf, cfg):
    return D.sample_contexts(T.with_texts(ot_dataset(spark, sf, cfg)), cfg)


@register("sample_contexts", SAMPLED_SQL.format(train=20, other=10) + """
SELECT file, line, split, n_before, n_after, ctxs FROM sampled""")
def q_sample_contexts(spark, sf):
    s = _sampled(spark, sf, SMALL)
    return s.select("file", "line", "split", F.col("n_before").cast("bigint").alias("n_before"),
                    F.col("n_after").cast("bigint").alias("n_after"), F.array_join("contexts", " ").alias("ctxs"))


@register("pad_row", SAMPLED_SQL.format(train=1000, other=200) + """
SELECT file, line, target || ' ' || ctxs || repeat(' ', CAST(greatest(1000 - n_after, 0) AS BIGINT)) AS text
FROM sampled""")
def q_pad_row(spark, sf):
    s = D.padded_lines(_sampled(spark, sf, DEFAULT), DEFAULT)
    return s.select("file", "line", "text")


@register("split_stats", SAMPLED_SQL.format(train=20, other=10) + """
SELECT split, round(avg(n_before), 6) AS avg_total, round(avg(n_after), 6) AS avg_final,
       count(*) AS n_examples, max(n_before) AS max_contexts
FROM sampled GROUP BY split""")
def q_split_stats(spark, sf):
    st = D.split_stats(_sampled(spark, sf, SMALL))
    return st.select("split", F.round("avg_total", 6).alias("avg_total"), F.round("avg_final", 6).alias("avg_final"),
                     "n_examples", "max_contexts")


@register("dataset_counts", BASE_SQL + """
SELECT (SELECT count(*) FROM smp) AS n_raw, (SELECT count(DISTINCT (file, line)) FROM smp) AS n_unique,
       (SELECT count(*) FROM dataset WHERE split = 'train') AS n_train""")
def q_dataset_counts(spark, sf):
    samples, _ = ot_samples(spark, sf)
    samples = V.materialize(samples.select("file", "line", "tree_id"))
    uniq = D.dedup_first(samples, ["file", "line"], ["tree_id"])
    n_raw, n_unique = samples.count(), uniq.count()
    ds = D.shuffle_split(uniq, DEFAULT, n_unique)
    return ds.agg(F.lit(n_raw).cast("bigint").alias("n_raw"), F.lit(n_unique).cast("bigint").alias("n_unique"),
                  F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).cast("bigint").alias("n_train"))


@register("dict_metadata", HIST_SQL + """
SELECT 1000::BIGINT AS max_contexts, (SELECT count(*) FROM dataset WHERE split = 'train') AS num_examples,
       (SELECT count(*) FROM vocab WHERE kind = 'subtoken') AS subtoken_size,
       (SELECT count(*) FROM vocab WHERE kind = 'node') AS node_size,
       (SELECT count(*) FROM vocab WHERE kind = 'target') AS target_size""")
def q_dict_metadata(spark, sf):
    from ..sinks import dictionary_metadata
    ds, vocab = train_vocab(spark, sf)
    return dictionary_metadata(ds, vocab, DEFAULT)


@register("c2s_parse", SAMPLED_SQL.format(train=1000, other=200) + """
SELECT split, target, n_after AS n_contexts, ctxs FROM sampled""")
def q_c2s_parse(spark, sf):
    s = D.padded_lines(_sampled(spark, sf, DEFAULT), DEFAULT).select("split", "text")
    parsed = parse_dataset_lines(s, "text")
    return parsed.select("split", F.array_join("target", "|").alias("target"),
                         F.size("contexts").cast("bigint").alias("n_contexts"),
                         F.array_join(F.transform("contexts", lambda c: F.concat_ws(
                             ",", F.array_join(c["start"], "|"), F.array_join(c["path"], "|"),
                             F.array_join(c["end"], "|"))), " ").alias("ctxs"))


# ----------------------------------------------------------------- D5 / D6
VOCAB_FLAG_SQL = HIST_SQL + """,
flags AS (
  SELECT d.split, c.start_tok IN (SELECT token FROM vocab WHERE kind = 'subtoken') AS i_s,
         c.path IN (SELECT token FROM vocab WHERE kind = 'node') AS i_p,
         c.end_tok IN (SELECT token FROM vocab WHERE kind = 'subtoken') AS i_e
  FROM ctx c JOIN dataset d ON d.tree_id = c.tree_id
)"""


def _flags(spark, sf):
    ds, vocab = train_vocab(spark, sf)
    return V.context_vocab_flags(ds, vocab, subtoken_limit=DEFAULT.subtoken_vocab_size, keep=["split"])


@register("context_in_vocab", VOCAB_FLAG_SQL + """
SELECT split, count(*) AS n_contexts, sum(CASE WHEN i_s AND i_p AND i_e THEN 1 ELSE 0 END)::BIGINT AS n_full
FROM flags GROUP BY split""")
def q_context_in_vocab(spark, sf):
    return _flags(spark, sf).groupBy("split").agg(
        F.count("*").alias("n_contexts"), F.sum(F.col("full").cast("bigint")).alias("n_full"))


@register("context_partly_in_vocab", VOCAB_FLAG_SQL + """
SELECT split, count(*) AS n_contexts, sum(CASE WHEN i_s OR i_p OR i_e THEN 1 ELSE 0 END)::BIGINT AS n_partial
FROM flags GROUP BY split""")
def q_context_partly_in_vocab(spark, sf):
    return _flags(spark, sf).groupBy("split").agg(
        F.count("*").alias("n_contexts"), F.sum(F.col("partial").cast("bigint")).alias("n_partial"))
