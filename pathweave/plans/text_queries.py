"""Registered word-level and compile-command queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tokens as W
from ..functions.text import decode_nested
from ..operators import commands as C
from ..session import table
from .registry import register
from .sql_ot import OPS_SQL, tok_sql


def _words(spark, sf):
    """Every space-separated word of every document, whole texts."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "w"))


WORDS_SQL = """words AS (
  SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) - 1 AS pos
  FROM (SELECT doc_id, string_split(text, ' ') AS l FROM documents)
)"""

NORM_SQL = ("CASE WHEN length(regexp_replace(w, '[^a-zA-Z]', '', 'g')) = 0 THEN lower(w) "
            "ELSE lower(regexp_replace(w, '[^a-zA-Z]', '', 'g')) END")


# ---------------------------------------------------------------- J1 / J2 / H4
@register("tokenize", f"""SELECT p_partkey,
  array_to_string({tok_sql('p_name')}, '|') AS name_tokens,
  array_to_string({tok_sql('p_type')}, '|') AS type_tokens,
  array_to_string({tok_sql('p_brand')}, '|') AS brand_tokens,
  len({tok_sql('p_brand', max_sub=0)}) AS n_brand
FROM part""")
def q_tokenize(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey",
                    W.join_subtokens(W.tokenize("p_name", 5)).alias("name_tokens"),
                    W.join_subtokens(W.tokenize("p_type", 5)).alias("type_tokens"),
                    W.join_subtokens(W.tokenize("p_brand", 5)).alias("brand_tokens"),
                    F.size(W.tokenize("p_brand", 0)).cast("bigint").alias("n_brand"))


@register("join_subtokens", f"""SELECT c_custkey, array_to_string({tok_sql('c_name', max_sub=0)}, '|') AS key,
  array_to_string({tok_sql('c_mktsegment', max_sub=0)}, '|') AS segment_key FROM customer""")
def q_join_subtokens(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", W.join_subtokens(W.tokenize("c_name", 0)).alias("key"),
                    W.join_subtokens(W.tokenize("c_mktsegment", 0)).alias("segment_key"))


@register("truncate_subtokens", f"""SELECT doc_id, pos, array_to_string({tok_sql('w', max_sub=2)}, '|') AS cut
FROM (WITH {WORDS_SQL} SELECT * FROM words) WHERE w <> ''""")
def q_truncate_subtokens(spark, sf):
    return _words(spark, sf).where(F.col("w") != "").select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), W.join_subtokens(W.tokenize("w", 2)).alias("cut"))


# ---------------------------------------------------------------- J5 / I4 / B6
@register("normalize_word", f"""WITH {WORDS_SQL}
SELECT {NORM_SQL} AS word, count(*) AS cnt FROM words GROUP BY 1""")
def q_normalize_word(spark, sf):
    return _words(spark, sf).groupBy(W.normalize_word("w").alias("word")).agg(F.count("*").alias("cnt"))


@register("distinct_ordered", f"""WITH {WORDS_SQL},
norm AS (SELECT doc_id, pos, {NORM_SQL} AS word FROM words),
firsts AS (SELECT doc_id, word, min(pos) AS p FROM norm GROUP BY doc_id, word)
SELECT doc_id, count(*) AS n_distinct, string_agg(word, ' ' ORDER BY p) AS words FROM firsts GROUP BY doc_id""")
def q_distinct_ordered(spark, sf):
    d = table(spark, sf, "documents")
    u = F.array_distinct(F.transform(F.split("text", " "), W.normalize_word))
    return d.select("doc_id", F.size(u).cast("bigint").alias("n_distinct"), F.array_join(u, " ").alias("words"))


@register("operator_token", f"""WITH {WORDS_SQL}
SELECT w AS token, count(*) AS cnt FROM words WHERE w IN ({OPS_SQL}) GROUP BY w""")
def q_operator_token(spark, sf):
    return (_words(spark, sf).where(W.is_operator_token("w"))
            .groupBy(F.col("w").alias("token")).agg(F.count("*").alias("cnt")))


# ---------------------------------------------------------------- B16 / J8
EVENT_WORD_SQL = "CASE WHEN event_type = 'error' THEN '<UNK>' ELSE event_type END"


def event_words(spark, sf):
    e = table(spark, sf, "events")
    return e.withColumn("word", F.when(F.col("event_type") == "error", F.lit(W.UNK)).otherwise(F.col("event_type")))


@register("legal_names", f"""SELECT event_id, {EVENT_WORD_SQL} AS word,
  {EVENT_WORD_SQL} NOT IN ('<UNK>', '<PAD>', '</S>') AS legal FROM events""")
def q_legal_names(spark, sf):
    return event_words(spark, sf).select("event_id", "word", W.is_legal_name("word").alias("legal"))


PATH_INFO_SQL = """path_info AS (
  SELECT DISTINCT props AS context, 'k' AS token1,
         'KEY|' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS path,
         'KEY' AS short_path, CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS token2
  FROM events
)"""


def path_info(spark, sf):
    """Path information of contexts: the distinct props of all events."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("bigint").cast("string")
    return e.select(F.col("props").alias("context"), F.lit("k").alias("token1"),
                    F.concat(F.lit("KEY|"), k).alias("path"), F.lit("KEY").alias("short_path"),
                    k.alias("token2")).distinct()


@register("format_path_info", f"""WITH {PATH_INFO_SQL}
SELECT context, token1 || ',' || short_path || ',' || token2 AS info FROM path_info""")
def q_format_path_info(spark, sf):
    return path_info(spark, sf).select("context", F.concat_ws(",", "token1", "short_path", "token2").alias("info"))


# ---------------------------------------------------------------- J7
@register("decode_nested", """SELECT doc_id, length(decode(encode(text))) AS n_chars,
  len(string_split(text, ' ')) AS n_words,
  len(string_split(replace(text, chr(10), ' '), ' ')) AS n_matrix
FROM documents""")
def q_decode_nested(spark, sf):
    d = table(spark, sf, "documents")
    as_bytes = F.encode("text", "UTF-8")
    words_b = F.transform(F.split("text", " "), lambda w: F.encode(w, "UTF-8"))
    matrix_b = F.transform(F.split("text", "\n"), lambda line: F.transform(F.split(line, " "),
                                                                          lambda w: F.encode(w, "UTF-8")))
    words = F.transform(words_b, lambda b: F.decode(b, "UTF-8"))
    matrix = F.transform(matrix_b, lambda row: F.transform(row, lambda b: F.decode(b, "UTF-8")))
    return d.select("doc_id", F.length(F.decode(as_bytes, "UTF-8")).cast("bigint").alias("n_chars"),
                    F.size(words).cast("bigint").alias("n_words"),
                    F.aggregate(matrix, F.lit(0).cast("bigint"), lambda acc, r: acc + F.size(r)).alias("n_matrix"))


@register("decode_nested_text", """SELECT doc_id, replace(text, ' ', '|') AS words,
  replace(replace(text, chr(10), '/'), ' ', '|') AS lines,
  replace(replace(replace(text, chr(10) || chr(10), '#'), chr(10), '/'), ' ', '|') AS paragraphs
FROM documents""")
def q_decode_nested_text(spark, sf):
    """Words, lines of words and paragraphs of lines of words, kept as bytes and decoded at depth 1, 2 and 3."""
    d = table(spark, sf, "documents")

    def words(t):
        return F.transform(F.split(t, " "), lambda w: F.encode(w, "UTF-8"))

    def lines(t):
        return F.transform(F.split(t, "\n"), words)

    stored = d.select("doc_id", words(F.col("text")).alias("w"), lines(F.col("text")).alias("l"),
                      F.transform(F.split("text", "\n\n"), lines).alias("p"))

    def line_text(x):
        return F.array_join(F.transform(x, lambda ws: F.array_join(ws, "|")), "/")
    return stored.select("doc_id", F.array_join(decode_nested("w", 1), "|").alias("words"),
                         line_text(decode_nested("l", 2)).alias("lines"),
                         F.array_join(F.transform(decode_nested("p", 3), line_text), "#").alias("paragraphs"))


# ---------------------------------------------------------------- B13 / B12 / D4 / G5
@register("object_file", """SELECT p_partkey, pos, name,
  (contains(string_split(name, '/')[-1], '.o.') OR suffix(string_split(name, '/')[-1], '.o')) AS is_object
FROM (SELECT p_partkey, unnest([p_name || '.o', 'lib/' || p_type || '.o.d', p_brand || '.c', p_name]) AS name,
             unnest([0, 1, 2, 3]) AS pos FROM part)""")
def q_object_file(spark, sf):
    p = table(spark, sf, "part")
    names = F.array(F.concat("p_name", F.lit(".o")), F.concat(F.lit("lib/"), "p_type", F.lit(".o.d")),
                    F.concat("p_brand", F.lit(".c")), F.col("p_name"))
    return p.select("p_partkey", F.posexplode(names).alias("pos", "name")).select(
        "p_partkey", "pos", "name", W.is_object_file("name").alias("is_object"))


def part_commands(spark, sf):
    p = table(spark, sf, "part")
    args = F.array(F.lit("clang++"), F.lit("-Xclang"), F.col("p_type"), F.lit("-c"), F.col("p_name"), F.lit("-o"),
                   F.concat(F.col("p_partkey").cast("string"), F.lit(".o")), F.concat(F.lit("-D"), F.col("p_brand")))
    return p.select(F.col("p_partkey").alias("cmd_id"), F.concat("p_name", F.lit(".cc")).alias("file"),
                    args.alias("arguments"), "p_type")


def known_paths(spark, sf):
    """The file system of the example: names of the PROMO parts exist."""
    return table(spark, sf, "part").where(F.col("p_type") == "PROMO").select(F.col("p_name").alias("path"))


ARGS_SQL = """args AS (
  SELECT p_partkey AS cmd_id, unnest(l) AS arg, generate_subscripts(l, 1) AS pos
  FROM (SELECT p_partkey, ['-Xclang', p_type, '-c', p_name, '-o', CAST(p_partkey AS VARCHAR) || '.o',
                           '-D' || p_brand] AS l FROM part)
),
flagged AS (
  SELECT *, lag(arg) OVER (PARTITION BY cmd_id ORDER BY pos) AS prev,
         arg IN (SELECT p_name FROM part WHERE p_type = 'PROMO') AS ex
  FROM args
),
cleaned AS (
  SELECT cmd_id, coalesce(string_agg(arg, '|' ORDER BY pos) FILTER (WHERE
           arg NOT IN ('-Xclang', '-c', '-o') AND coalesce(prev, '') <> '-Xclang' AND NOT ex
           AND NOT (contains(arg, '.o.') OR suffix(arg, '.o'))), '') AS args
  FROM flagged GROUP BY cmd_id
)"""


@register("compile_args", f"WITH {ARGS_SQL} SELECT cmd_id, args FROM cleaned")
def q_compile_args(spark, sf):
    out = C.clean_compile_args(part_commands(spark, sf), known_paths(spark, sf))
    return out.select("cmd_id", F.array_join("args", "|").alias("args"))


@register("file_commands", f"""WITH {ARGS_SQL},
firsts AS (SELECT p_name || '.cc' AS file, min(p_partkey) AS cmd_id FROM part WHERE p_type <> 'ECONOMY' GROUP BY 1)
SELECT f.file, c.args FROM firsts f JOIN cleaned c ON c.cmd_id = f.cmd_id""")
def q_file_commands(spark, sf):
    cmds = part_commands(spark, sf)
    cleaned = C.clean_compile_args(cmds, known_paths(spark, sf))
    # the compile database holds the non-ECONOMY parts; every part name is a source file
    db = cmds.where(F.col("p_type") != "ECONOMY").select("file", "cmd_id").join(cleaned, "cmd_id")
    files = cmds.select("file").distinct()
    return C.file_commands(files, db, ["cmd_id"]).select("file", F.array_join("args", "|").alias("args"))


def quoted_commands(spark, sf):
    """Compile database rows that give a command line: parts built in two folders, names and values quoted."""
    p = table(spark, sf, "part")
    folder = F.when(F.col("p_size") % 2 == 0, "/src/even").otherwise("/src/odd/")
    line = F.concat(F.lit("clang++  -Xclang '"), "p_type", F.lit("' -c \"../x/./..//"), folder_name(), F.lit("/"), "p_name",
                    F.lit(".cc\" -o "), F.col("p_partkey").cast("string"), F.lit(".o '-DTYPE="), "p_type",
                    F.lit(" \\' \"-DBRAND=\\\""), "p_brand", F.lit("\\\"\" -I\\ "), "p_brand", F.lit(" -I'' \"\""))
    return p.select(F.col("p_partkey").alias("cmd_id"), folder.alias("directory"),
                    F.concat(F.lit("./"), "p_name", F.lit(".cc")).alias("file"),
                    F.lit(None).cast("array<string>").alias("arguments"), line.alias("command"))


def folder_name():
    return F.when(F.col("p_size") % 2 == 0, "even").otherwise("odd")


def even_promo_files(spark, sf):
    """The file system of that database: only the even folder holds the sources, those of the PROMO parts."""
    return table(spark, sf, "part").where(F.col("p_type") == "PROMO").select(
        F.concat(F.lit("/src//even/./"), "p_name", F.lit(".cc")).alias("path"))


# a part's source is named from its folder's sibling; it goes where that file exists
@register("compile_args_quoted", """SELECT p_partkey AS cmd_id,
  CASE WHEN p_size % 2 = 0 THEN '/src/even/' ELSE '/src/odd/' END || p_name || '.cc' AS path,
  CASE WHEN p_size % 2 = 0 AND p_name IN (SELECT p_name FROM part WHERE p_type = 'PROMO') THEN ''
       ELSE '../x/./..//' || CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END || '/' || p_name || '.cc;' END
    || '-DTYPE=' || p_type || ' ' || chr(92) || ';-DBRAND="' || p_brand || '";-I ' || p_brand || ';-I;' AS args
FROM part""")
def q_compile_args_quoted(spark, sf):
    db = C.parse_commands(quoted_commands(spark, sf))
    cleaned = C.clean_compile_args(db, even_promo_files(spark, sf))
    return db.select("cmd_id", "path").join(cleaned, "cmd_id").select("cmd_id", "path", F.array_join("args", ";").alias("args"))


@register("command_coverage", """WITH asked AS (SELECT DISTINCT p_name AS f FROM part),
has AS (SELECT DISTINCT p_name AS f FROM part WHERE p_type = 'PROMO' AND p_size % 2 = 0)
SELECT 2 * count(*) AS n_files, count(has.f) AS n_with_command, 2 * count(*) - count(has.f) AS n_without_command
FROM asked LEFT JOIN has ON has.f = asked.f""")
def q_command_coverage(spark, sf):
    p = table(spark, sf, "part")
    files = p.select(F.explode(F.array(F.lit("/src/even/"), F.lit("/src/x/../odd//"))).alias("d"), "p_name").select(
        F.concat("d", "p_name", F.lit(".cc")).alias("file"))
    promo = p.where((F.col("p_type") == "PROMO") & (F.col("p_size") % 2 == 0)).select(F.col("p_partkey").alias("cmd_id"))
    db = C.parse_commands(quoted_commands(spark, sf).join(promo, "cmd_id", "left_semi"))
    return C.command_coverage(files, db.select(F.col("path").alias("file")))
