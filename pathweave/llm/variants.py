"""Spelling variants: words one edit apart, found by a frontier of states over a trie kept as an edge table.

The trie is relational and path-compressed.  A node is a prefix; an edge goes
from a node to the longest prefix that all words behind its first character
share, and says whether that prefix is a word itself.  It is built from the
root down, one aggregation a level: the common prefix of a group of words is
that of its least and its greatest word, so no group is gathered.

Each word stands in the trie twice, read forwards and backwards (a mark before
it keeps the two apart).  Two words one edit apart share the first or the last
half of either, so only edits in the second half of a reading are looked for,
below nodes that few words share.

A state is (word, position, node, edits).  Without edits, a word stands at the
nodes of its own path, which the construction wrote down.  From each of these
in its second half, one join with the edges of the node makes the edit: a label is consumed with
one character replaced, missing in the word or too many in it.  States with an
edit only go on where the rest of the word matches a label exactly, one join a
level on the edge's first character; a state at the end of its word and at a
node that is a word is a neighbour.

Scale: the edges of a node are at most as many as there are characters.  A node
that many words go through is split: its words get one of 1 + words / ``salt_words``
salts, and its edges are repeated for each.  All joins have keys; nothing is
collected but the number of words.

Defined results: null words are left out; a word given twice or more counts
with the sum of its n; a null n counts as 0; ties between forms go to the smallest in
code-point order; an empty table gives an empty result; other columns are not
read.  Words may be of any length, and hold any character but U+0000.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.session import cut_lineage

END = "\0"      # stands for the end of a word where an edge's first character stands else


@dataclass(frozen=True)
class VariantConfig:
    ratio: int = 5              # a form is at least this many times as frequent as the word
    salt_words: int = 4096      # words of one node that one salt stands for


# ------------------------------------------------------------------ the trie
def _common_prefix(lo: Column, hi: Column) -> Column:
    """Number of leading characters that two strings share."""
    same = F.transform(F.arrays_zip(F.split(lo, "").alias("a"), F.split(hi, "").alias("b")), lambda x: x["a"].eqNullSafe(x["b"]))
    return F.when(lo == hi, F.length(lo)).otherwise(F.array_position(same, F.lit(False)).cast("int") - 1)


def _half(word: Column) -> Column:
    """Characters of a reading, mark included, that are not edited: half of the word or one less."""
    return 1 + F.floor((F.length(word) - 1) / 2)


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (word, n), distinct: paths (word, node, depth, under) and

    edges (node, under, head, n_words, label, child, ends, n): ``under`` counts the words that go
    through the node, ``head`` is the node and the label's first character, ``ends`` says that
    the child is a word, ``n`` being its count.  Paths hold the nodes from which an edit in the
    second half of the word can be reached.
    """
    live = cut_lineage(words.select("word", F.lit(0).alias("depth"), F.lit(words.count()).cast("long").alias("under"), "n"))
    paths, edges = [], []
    while not live.isEmpty():
        onward = live.where(F.length("word") > F.col("depth")).withColumn(
            "head", F.substring("word", F.lit(1), F.col("depth") + 1))
        groups = onward.groupBy("head").agg(F.count(F.lit(1)).alias("n_words"), F.max("under").alias("under"),
                                            F.min(F.struct("word", "n")).alias("lo"), F.max("word").alias("hi"))
        at = F.length("head") - 1
        level = cut_lineage(groups.withColumn("to", _common_prefix(F.col("lo.word"), F.col("hi"))).select(
            F.substring("head", F.lit(1), at).alias("node"), "under", "head", "n_words",
            F.col("lo.word").substr(F.length("head"), F.col("to") - at).alias("label"),
            F.col("lo.word").substr(F.lit(1), F.col("to")).alias("child"),
            (F.length("lo.word") == F.col("to")).alias("ends"), F.col("lo.n").alias("n")))
        edges.append(level)
        ended = live.where(F.length("word") <= F.col("depth")).select("word", "depth", "under", "n", F.col("depth").alias("to"),
                                                                    F.lit(0).cast("long").alias("n_words"))
        passed = cut_lineage(onward.join(level.select("head", F.length("child").alias("to"), "n_words"), "head")
                             .drop("head").unionByName(ended))
        paths.append(passed.where(F.col("to") >= _half(F.col("word"))).select(
            "word", F.substring("word", F.lit(1), F.col("depth")).alias("node"), "depth", "under"))
        live = passed.where("n_words > 1").select("word", F.col("to").alias("depth"), F.col("n_words").alias("under"), "n")
    if not edges:
        none = words.where(F.lit(False))
        empty, zero = F.lit("").alias, F.lit(0).cast("long").alias
        return (none.select("word", empty("node"), F.lit(0).alias("depth"), zero("under")),
                none.select(empty("node"), zero("under"), empty("head"), zero("n_words"), empty("label"), empty("child"),
                            F.lit(True).alias("ends"), "n"))
    return reduce(DataFrame.unionByName, paths), reduce(DataFrame.unionByName, edges)


# ------------------------------------------------------------------ the frontier
def _one_edit(paths: DataFrame, edges: DataFrame, cfg: VariantConfig) -> DataFrame:
    """States (word, pos, node) after the edit, from every state without one."""
    salts = F.floor(F.col("under") / cfg.salt_words)
    here = paths.withColumn("salt", F.pmod(F.xxhash64("word"), salts + 1))
    there = edges.select("node", "head", "label", "child", F.explode(F.sequence(F.lit(0).cast("long"), salts)).alias("salt"))
    k = F.length("label")

    def ends_at(extra: int) -> Column:
        """Place in the word after the label, if k + extra of its characters are one edit away from the label."""
        piece = F.col("word").substr(F.col("depth") + 1, k + extra)
        to = F.col("depth") + k + extra
        return F.when((F.length("word") >= to) & (F.levenshtein(piece, F.col("label"), 1) == 1), to)

    # equal lengths one edit apart differ by one replaced character, unequal ones by one inserted or deleted
    places = F.filter(F.array(ends_at(0), ends_at(-1), ends_at(1)), lambda p: p.isNotNull())
    half = _half(F.col("word"))
    own = (F.length("child") >= half) & F.col("word").startswith(F.col("head"))
    return here.join(there, ["node", "salt"]).where((F.col("depth") >= half) | own).select("word", F.explode(places).alias("pos"), F.col("child").alias("node"))


def _word(reading: Column) -> Column:
    """The word of one of its two readings."""
    rest = reading.substr(F.lit(2), F.length(reading))
    return F.when(reading.startswith("<"), F.reverse(rest)).otherwise(rest)


def neighbours(words: DataFrame, cfg: VariantConfig = VariantConfig()) -> DataFrame:
    """From (word, n), distinct: (word, near, near_n) of all ordered pairs of words one edit apart."""
    back = F.concat(F.lit("<"), F.reverse("word"))
    paths, edges = trie(words.select(F.explode(F.array(F.concat(F.lit(">"), "word"), back)).alias("word"), "n"))
    ends = edges.where("ends").select(F.concat("child", F.lit(END)).alias("head"), F.lit("").alias("label"), "child",
                                      F.lit(True).alias("over"), "n")
    steps = cut_lineage(edges.select("head", "label", "child", F.lit(False).alias("over"), "n").unionByName(ends))
    states, found = _one_edit(paths, edges, cfg), []
    while True:
        here = F.when(F.col("pos") >= F.length("word"), F.lit(END)).otherwise(F.col("word").substr(F.col("pos") + 1, F.lit(1)))
        moved = states.withColumn("head", F.concat("node", here)).drop("node").join(steps, "head") \
            .where(F.col("word").substr(F.col("pos") + 1, F.length("label")) == F.col("label")) \
            .select("word", (F.col("pos") + F.length("label")).alias("pos"), F.col("child").alias("node"), "over", "n")
        moved = cut_lineage(moved)
        found.append(moved.where("over").select(_word(F.col("word")).alias("word"), _word(F.col("node")).alias("near"),
                                                F.col("n").alias("near_n")))
        states = moved.where(~F.col("over")).select("word", "pos", "node")
        if states.isEmpty():
            return reduce(DataFrame.unionByName, found).distinct()


# ------------------------------------------------------------------ forms
def roots(forms: DataFrame) -> DataFrame:
    """From (word, form): (word, root), the last word on following forms, by pointer doubling.

    A form is ``ratio`` times as frequent as its word, so no chain is longer
    than the logarithm of the largest count.
    """
    ptr = cut_lineage(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        far = ptr.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = cut_lineage(ptr.join(far, "root").select("word", F.col("further").alias("root"),
                                                          (F.col("further") != F.col("root")).alias("moved")))
        ptr = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return ptr


def group(words: DataFrame, cfg: VariantConfig = VariantConfig()) -> DataFrame:
    """From (word, n): word, n, n_near, form, form_n, root for every word."""
    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    vocab = cut_lineage(words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum(n).alias("n")))
    best = neighbours(vocab, cfg).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(
        F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    near = vocab.join(best, "word", "left")
    is_form = -F.col("top.less") >= cfg.ratio * F.col("n")
    forms = cut_lineage(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("top.near")).alias("form"), F.when(is_form, -F.col("top.less")).cast("long").alias("form_n")))
    return forms.join(roots(forms), "word")
