"""Quality rules as a short-circuit cascade.

The counts that several rules share are columns of one projection; the other
rules look at the text themselves.  A random sample of the whole table, of a
stated size, is evaluated once for each rule: that gives the time it takes a
row, and the rows it rejects.  Rules are then put in order one at a time, each
time that with the most rejections per cost among the sample's rows that the
rules before it let through, and joined into nested conditions that Spark
leaves at the first rule that rejects.  Times differ from run to run, and so
may the order; it changes the work, never the verdict.

Defined results: a null or empty text has no words, so it is base_failed and
not kept; rows are independent, so ties and repeated rows need no rule; an
empty table or sample leaves the rules in their declared order;
other columns of the input are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.session import cut_lineage

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
# a word that the next word repeats
STUTTER = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)(?=[\x20\x09-\x0D]++\1(?![^\x20\x09-\x0D]))"
WINDOW = 8
SAMPLE_ROWS = 2000      # expected rows of the sample that orders the rules; bounds what the driver receives
COPIES = 4              # times that each sampled row is evaluated while a rule's time is taken
REPEATS = 2             # runs of which the shorter counts; the first compiles the expression


def words(text: Column) -> Column:
    """Maximal runs of characters other than the six ASCII white spaces."""
    return F.array_remove(F.split(text, f"{SPACE}+", -1), "")


def word_lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def window_hashes(ws: Column, n: int = WINDOW) -> Column:
    """A 64-bit hash of each n-word window, in order."""
    return F.when(F.size(ws) >= n, F.transform(F.sequence(F.lit(1), F.size(ws) - (n - 1)),
                                               lambda i: F.xxhash64(F.slice(ws, i, n)))) \
        .otherwise(F.array().cast("array<bigint>"))


def with_counts(docs: DataFrame, text: str = "text", n: int = WINDOW) -> DataFrame:
    """doc_id, the text and its counts n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Equal windows are found by sorting (hash, position) pairs within the row,
    and only in texts where some hash repeats: one window per word in memory.
    """
    w = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    w = w.withColumns({"ws": words(F.col("text")), "lines": word_lines(F.col("text"))})
    w = w.select(
        "doc_id", "text", F.size("ws").cast("long").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        window_hashes(F.col("ws"), n).alias("h"))
    pair = "array<struct<key:bigint,at:bigint>>"
    w = w.withColumn("pairs", F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("key"), i.cast("long").alias("at"))))).cast(pair))
    none = F.array(F.lit(None).cast("struct<key:bigint,at:bigint>"))
    beside = F.arrays_zip(F.col("pairs").alias("x"),
                          F.concat(none, F.slice("pairs", 1, F.size("pairs") - 1)).alias("p"),
                          F.concat(F.slice("pairs", 2, F.size("pairs") - 1), none).alias("q"))
    twice = F.filter(beside, lambda z: F.coalesce(z["x"]["key"] == z["p"]["key"], F.lit(False))
                     | F.coalesce(z["x"]["key"] == z["q"]["key"], F.lit(False)))
    starts = F.sort_array(F.transform(twice, lambda z: z["x"]["at"]))
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-n).cast("long").alias("last"))
    covered = F.aggregate(starts, zero, lambda a, p: F.struct(
        (a["sum"] + F.least(F.lit(n).cast("long"), p - a["last"])).alias("sum"), p.alias("last")), lambda a: a["sum"])
    return w.withColumn("n_repeat_words", F.when(F.col("pairs").isNull(), F.lit(0).cast("long")).otherwise(covered)) \
        .drop("h", "pairs")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is an expression over the columns of with_counts."""
    name: str
    rejects: Callable[[], Column]


def _chars_of(pattern: str) -> Column:
    return F.length("text") - F.length(F.regexp_replace("text", pattern, ""))


RULES = (
    Rule("few_words", lambda: F.col("n_words") < 20),
    Rule("repeated_words", lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    Rule("symbols", lambda: F.col("n_symbols") > 0.2 * F.col("n_words")),
    Rule("word_length", lambda: ~F.col("word_chars").between(2 * F.col("n_words"), 20 * F.col("n_words"))),
    Rule("duplicate_lines", lambda: 100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
    Rule("capitals", lambda: _chars_of(r"\p{Lu}") > 0.5 * F.col("word_chars")),
    Rule("exclamations", lambda: _chars_of("!") > 0.5 * F.col("n_words")),
    Rule("stutter", lambda: F.regexp_count("text", F.lit(STUTTER)) > 0.3 * F.col("n_words")),
    Rule("no_letters", lambda: _chars_of(r"\p{L}") < 0.5 * F.col("word_chars")),
)


def sampled(docs: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 0) -> DataFrame:
    """About ``rows`` rows, each row of the table as likely as any other; small tables whole."""
    n = docs.count()
    return docs if n <= rows else docs.sample(rows / n, seed)


def verdicts(sample: DataFrame, rules: Sequence[Rule]) -> list[tuple[bool, ...]]:
    """Which rules reject, for each row of a sample."""
    return [tuple(map(bool, r)) for r in sample.select(*[r.rejects().alias(f"r{i}") for i, r in enumerate(rules)]).collect()]


def seconds(sample: DataFrame, rules: Sequence[Rule], clock: Callable[[], float] = time.perf_counter) -> list[float]:
    """The time that each rule takes over a stored sample, beyond that of reading it.

    Nothing shorter than what two equal runs differ by is told apart.
    """
    copies = sample.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))

    def runs(condition: Column) -> list[float]:
        out = []
        for _ in range(REPEATS):
            began = clock()
            copies.agg(F.count_if(condition)).collect()
            out.append(clock() - began)
        return out
    runs(F.octet_length("text") < 0)
    read = runs(F.octet_length("text") < 0)
    least = max(read) - min(read) + 1e-3
    return [max(min(runs(r.rejects())) - min(read), least) for r in rules]


def by_rejection_per_cost(costs: Sequence[float], rows: Sequence[Sequence[bool]]) -> list[int]:
    """Places of the rules: next is always that with most rejections per cost among the rows still kept (ties: as declared)."""
    left, out = list(range(len(costs))), []
    while left:
        best = max(left, key=lambda i: ((sum(r[i] for r in rows) + 1) / (len(rows) + 2) / costs[i], -i))
        left.remove(best)
        out.append(best)
        rows = [r for r in rows if not r[best]]
    return out


def ordered(sample: DataFrame, rules: Sequence[Rule] = RULES) -> list[Rule]:
    """The rules in the order in which they are to be evaluated, from a sample with the columns of with_counts."""
    stored = cut_lineage(sample)
    rows = verdicts(stored, rules)
    return [rules[i] for i in by_rejection_per_cost(seconds(stored, rules), rows)] if rows else list(rules)


def cascade(rules: list[Rule]) -> Column:
    """True where some rule rejects; rules after the first that does are not evaluated."""
    out = F.lit(False)
    for r in reversed(rules):
        out = F.when(r.rejects(), True).otherwise(out)
    return out


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The counts of with_counts and ``kept``, false where a rule of the cascade rejects."""
    order = ordered(with_counts(sampled(docs.select("doc_id", "text"), sample_rows)), rules)
    return with_counts(docs).withColumn("kept", ~cascade(order))
