"""Registered prediction and BLEU queries (events, conversations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tokens as W
from ..operators import predictions as P
from ..operators.vocab import global_rank
from ..session import table
from .registry import register
from .text_queries import EVENT_WORD_SQL, PATH_INFO_SQL, event_words, path_info

TOPK = 5


def suggestions(spark, sf):
    """Steps of a method: user and event type (error plays UNK), once for its odd and once for its even events.

    So a word is suggested twice by most users; steps are numbered by first event, word, half.
    """
    from pyspark.sql import Window
    e = halved(spark, sf)
    firsts = e.groupBy("method", "word", "half").agg(F.min("ts").alias("first_ts"))
    place = F.row_number().over(Window.partitionBy("method").orderBy("first_ts", "word", "half")) - 1
    return firsts.select("method", "word", "half", place.cast("bigint").alias("step"))


def halved(spark, sf):
    return event_words(spark, sf).select(F.col("user_id").alias("method"), "word", (F.col("event_id") % 2).alias("half"),
                                         "ts", F.col("props").alias("context"), F.col("value").alias("score"))


def attention(spark, sf):
    """One row per event: its step, its word, context = props, weight = value."""
    return halved(spark, sf).join(suggestions(spark, sf), ["method", "word", "half"])


def known_paths(spark, sf):
    """Path information of the contexts with an even k; the others play contexts without any."""
    return path_info(spark, sf).where(F.col("token2").cast("bigint") % 2 == 0)


TOPK_SQL = f"""ev AS (
  SELECT user_id AS method, {EVENT_WORD_SQL} AS word, event_id % 2 AS half, ts, props AS context, value FROM events
),
steps AS (
  SELECT method, word, half, row_number() OVER (PARTITION BY method ORDER BY first_ts, word, half) - 1 AS step
  FROM (SELECT method, word, half, min(ts) AS first_ts FROM ev GROUP BY 1, 2, 3)
),
att AS (
  SELECT s.method, s.step, s.word, e.context, max(e.value) AS score
  FROM steps s JOIN ev e ON e.method = s.method AND e.word = s.word AND e.half = s.half
  GROUP BY 1, 2, 3, 4
),
topk AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY method, step ORDER BY score DESC, context) AS rank
    FROM att WHERE word NOT IN ('<UNK>', '<PAD>', '</S>')) WHERE rank <= {TOPK}
)"""
KNOWN_SQL = f"""{PATH_INFO_SQL},
known AS (SELECT * FROM path_info WHERE CAST(token2 AS BIGINT) % 2 = 0)"""


@register("attention_topk", f"WITH {TOPK_SQL} SELECT method, step, word, rank, context, score FROM topk")
def q_attention_topk(spark, sf):
    return P.attention_topk(attention(spark, sf), TOPK).select(
        "method", "step", "word", F.col("rank").cast("bigint").alias("rank"), "context", "score")


@register("attention_paths", f"""WITH {TOPK_SQL}, {KNOWN_SQL}
SELECT t.method, t.step, t.word, t.rank, t.score, p.path, p.token1, p.token2
FROM topk t JOIN known p ON p.context = t.context""")
def q_attention_paths(spark, sf):
    top = P.attention_topk(attention(spark, sf), TOPK)
    return P.attention_paths(top, known_paths(spark, sf)).select(
        "method", "step", "word", F.col("rank").cast("bigint").alias("rank"), "score", "path", "token1", "token2")


PARSE_SQL = f"""WITH {TOPK_SQL}, {KNOWN_SQL},
methods AS (SELECT user_id AS method, row_number() OVER (ORDER BY user_id) - 1 AS method_id,
                   'user' || user_id AS original_name FROM (SELECT DISTINCT user_id FROM events)),
words AS (SELECT method, word, step FROM steps WHERE word NOT IN ('<UNK>', '<PAD>', '</S>')),
tp AS (SELECT t.*, p.path, p.token1, p.token2 FROM topk t JOIN known p ON p.context = t.context)
SELECT m.method_id, m.original_name, w.step, w.word, count(tp.rank) AS n_paths,
       coalesce(string_agg(tp.path || ',' || tp.token1 || ',' || tp.token2, ' ' ORDER BY tp.rank), '') AS paths
FROM methods m LEFT JOIN words w ON w.method = m.method
LEFT JOIN tp ON tp.method = w.method AND tp.step = w.step
GROUP BY m.method_id, m.original_name, w.step, w.word"""


@register("parse_predictions", PARSE_SQL)
def q_parse_predictions(spark, sf):
    top = P.attention_paths(P.attention_topk(attention(spark, sf), TOPK), known_paths(spark, sf))
    words = suggestions(spark, sf).where(W.is_legal_name("word")).select("method", "step", "word")
    users = event_words(spark, sf).select(F.col("user_id").alias("method")).distinct()
    methods = global_rank(users, [F.col("method")], "method_id").withColumn(
        "original_name", F.concat(F.lit("user"), F.col("method").cast("string")))
    out = P.parse_predictions(top, words, methods)
    return out.select("method_id", "original_name", "step", "word",
                      F.size("paths").cast("bigint").alias("n_paths"),
                      F.array_join(F.transform("paths", lambda p: F.concat_ws(",", p["path"], p["token1"], p["token2"])),
                                   " ").alias("paths"))


SEQ_WORD_SQL = ("CASE WHEN regexp_matches(w, '[a-zA-Z]') THEN lower(regexp_replace(w, '[^a-zA-Z]', '', 'g')) "
                "ELSE '<UNK>' END")


@register("parse_sequences", f"""WITH toks AS (
  SELECT conv_id, turn, unnest(l) AS w, generate_subscripts(l, 1) AS pos
  FROM (SELECT conv_id, turn, string_split(text, ' ') AS l FROM conversations)
), mapped AS (SELECT conv_id, turn, pos, {SEQ_WORD_SQL} AS word FROM toks)
SELECT conv_id, turn, count(*) AS n_words,
       count(*) FILTER (WHERE word NOT IN ('<UNK>', '<PAD>', '</S>')) AS n_legal,
       coalesce(string_agg(word, '|' ORDER BY pos) FILTER (WHERE word NOT IN ('<UNK>', '<PAD>', '</S>')), '') AS seq
FROM mapped GROUP BY conv_id, turn""")
def q_parse_sequences(spark, sf):
    c = table(spark, sf, "conversations")
    words = F.transform(F.split("text", " "), lambda w: F.when(w.rlike("[a-zA-Z]"), W.normalize_word(w))
                        .otherwise(F.lit(W.UNK)))
    legal = P.filter_sequences(None, "words")
    out = c.select("conv_id", "turn", words.alias("words")).withColumn("legal", legal)
    return out.select("conv_id", "turn", F.size("words").cast("bigint").alias("n_words"),
                      F.size("legal").cast("bigint").alias("n_legal"), F.array_join("legal", "|").alias("seq"))


def conversation_pairs(spark, sf):
    """Reference = a turn, hypothesis = the next turn of the same conversation (equi-join)."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.regexp_extract_all("text", F.lit(r"\S+"), 0)
                                                 .alias("w"))
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("hyp"))
    return c.join(nxt, ["conv_id", "turn"]).select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("pair_id"),
        F.col("w").alias("ref"), "hyp")


BLEU_SQL = r"""WITH c AS (SELECT conv_id, turn, regexp_extract_all(text, '\S+') AS w FROM conversations),
pairs AS (SELECT a.conv_id || ':' || a.turn AS pair_id, a.w AS ref, b.w AS hyp
          FROM c a JOIN c b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1),
ns AS (SELECT unnest([1, 2, 3, 4]) AS n),
hg AS (SELECT pair_id, n, gram, count(*) AS cnt FROM (
         SELECT pair_id, n, array_to_string(hyp[i:i + n - 1], ' ') AS gram
         FROM (SELECT pair_id, hyp, n, unnest(generate_series(1, len(hyp) - n + 1)) AS i FROM pairs, ns))
       GROUP BY 1, 2, 3),
rg AS (SELECT pair_id, n, gram, count(*) AS cnt FROM (
         SELECT pair_id, n, array_to_string(ref[i:i + n - 1], ' ') AS gram
         FROM (SELECT pair_id, ref, n, unnest(generate_series(1, len(ref) - n + 1)) AS i FROM pairs, ns))
       GROUP BY 1, 2, 3),
cl AS (SELECT hg.n, sum(least(hg.cnt, coalesce(rg.cnt, 0))) AS m, sum(hg.cnt) AS t
       FROM hg LEFT JOIN rg ON rg.pair_id = hg.pair_id AND rg.n = hg.n AND rg.gram = hg.gram GROUP BY hg.n),
p AS (SELECT max(CASE WHEN n = 1 THEN m / t END) AS p1, max(CASE WHEN n = 2 THEN m / t END) AS p2,
             max(CASE WHEN n = 3 THEN m / t END) AS p3, max(CASE WHEN n = 4 THEN m / t END) AS p4 FROM cl),
l AS (SELECT sum(len(hyp)) AS hyp_len, sum(len(ref)) AS ref_len FROM pairs)
SELECT round(CASE WHEN p1 = 0 OR p2 = 0 OR p3 = 0 OR p4 = 0 THEN 0.0 ELSE
         (CASE WHEN hyp_len < ref_len THEN exp(1 - ref_len / hyp_len) ELSE 1.0 END)
         * exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) * 100 END, 6) AS bleu,
       round(CASE WHEN hyp_len < ref_len THEN exp(1 - ref_len / hyp_len) ELSE 1.0 END, 6) AS bp,
       round(p1 * 100, 6) AS p1, round(p2 * 100, 6) AS p2, round(p3 * 100, 6) AS p3, round(p4 * 100, 6) AS p4,
       hyp_len::BIGINT AS hyp_len, ref_len::BIGINT AS ref_len
FROM p, l"""


@register("corpus_bleu", BLEU_SQL)
def q_corpus_bleu(spark, sf):
    b = P.corpus_bleu(conversation_pairs(spark, sf))
    return b.select(*[F.round(c, 6).alias(c) for c in ("bleu", "bp", "p1", "p2", "p3", "p4")], "hyp_len", "ref_len")
