"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text, with exception phrases.

Folding: lower case, homoglyphs and accented Latin letters to plain letters,
digits and signs that stand for letters to those letters.  An entry matches
where a word starts; the longest entry at a place counts.  A match inside an
exception phrase does not count.

Fitting uses a bounded, documented sample: the ``fit_rows`` labelled rows with
the smallest hash of doc_id.  Entries are words' beginnings (``least_chars`` to
``most_chars`` folded characters, and whole words) that are much likelier in
toxic texts, weighted by their log odds; an exception phrase is an entry with
the word before or after it that occurs, again and again, in clean texts only.
A logistic curve over two numbers of a text (sum of weights, and that sum
against the text's length) makes the score.  Everything else covers all rows.

Defined results: a null or empty text has no match and scores as the curve says
at zero; rows are independent (ties and repeated rows need no rule); labels of
a doc_id that occur twice count twice; null labels and null doc_ids are not
learnt from; with no labels at all, or of one class only, the score is the
share of toxic labels (0 without any), and 0 where no labelled document is there;
an empty table gives an empty result; a text may be of any length.
Only doc_id and text are read, and only the text enters a score.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.session import cut_lineage

from .common import give_back, release_worker

# Letters of other scripts that look like Latin ones, and digits and signs used in their place.
HOMOGLYPHS = dict(zip("абвгеёзікмнопрстухһјѕԁԛԝαβγεηικνορτυχωı", "abbreezikmhonpctyxhjsdqwabyenikvoptuxwi"))
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "l"}


@dataclass(frozen=True)
class FitConfig:
    fit_rows: int = 20_000       # bound of the labelled sample
    least_chars: int = 4
    most_chars: int = 8
    least_rows: int = 6          # toxic rows that an entry must occur in
    least_odds: float = 1.9      # what an entry's log odds must reach, less 1.5 standard errors
    most_entries: int = 20_000   # bound of the lexicon; the likeliest stay
    exception_rows: int = 5      # clean rows that an exception phrase must occur in


@dataclass(frozen=True)
class Model:
    lexicon: dict                # folded word start -> weight
    exceptions: frozenset = frozenset()
    curve: tuple = (0.0, 0.0, 0.0)
    flat: float | None = None    # the score of every text, where there was nothing to learn


def _table() -> dict[int, str]:
    """Folding of single characters; accented Latin letters by their decomposition."""
    out = {ord(a): b for a, b in HOMOGLYPHS.items()}
    out |= {ord(a): b for a, b in DIGITS.items()}
    for c in range(0xC0, 0x250):
        plain = unicodedata.normalize("NFKD", chr(c).lower())[0]
        if plain.isascii() and plain.isalpha():
            out[c] = plain
    for c in range(0xFF21, 0xFF5B):
        plain = unicodedata.normalize("NFKC", chr(c)).lower()
        if plain.isalpha():
            out[c] = plain
    return out


TABLE = _table()
_SIGN = re.compile(r"[@$!|](?=[a-z])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    folded = text.lower().translate(TABLE)
    return _SIGN.sub(lambda m: SIGNS[m.group()], folded) if any(c in folded for c in SIGNS) else folded


class Matcher:
    """The lexicon's automaton; built once per task."""

    def __init__(self, model: Model):
        import ahocorasick
        self.model = model
        self.trie = ahocorasick.Automaton()
        for w in model.lexicon:
            self.trie.add_word(w, w)
        self.empty = not model.lexicon
        if not self.empty:
            self.trie.make_automaton()

    def matches(self, folded: str) -> list[tuple[int, str]]:
        """(start, entry): the longest entry at each word start."""
        if self.empty:
            return []
        at: dict[int, str] = {}
        for end, w in self.trie.iter(folded):
            start = end - len(w) + 1
            if (not start or not folded[start - 1].isalnum()) and len(w) > len(at.get(start, "")):
                at[start] = w
        return sorted(at.items())

    def phrases(self, folded: str, start: int) -> list[tuple[str, str]]:
        """The matched word with the one before it and the one after it."""
        own = _WORD.match(folded, start)
        own_end = own.end() if own else start
        before = _WORD.findall(folded[max(0, start - 40):start])[-1:]
        after = _WORD.findall(folded[own_end:own_end + 40])[:1]
        word = folded[start:own_end]
        return [(w, word) for w in before] + [(word, w) for w in after]

    def features(self, text: str) -> tuple[float, float]:
        folded = fold(text)
        total = 0.0
        for start, w in self.matches(folded):
            if self.model.exceptions and not self.model.exceptions.isdisjoint(self.phrases(folded, start)):
                continue
            total += self.model.lexicon[w]
        return np.log1p(total), total / np.sqrt(1.0 + len(folded) / 6.0)

    def score(self, text: str) -> float:
        if self.model.flat is not None:
            return self.model.flat
        a, b, c = self.model.curve
        x, y = self.features(text)
        return float(1.0 / (1.0 + np.exp(-np.clip(a + b * x + c * y, -35, 35))))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def _starts(folded: str, cfg: FitConfig) -> set[str]:
    out = set()
    for w in set(_WORD.findall(folded)):
        out.update(w[:k] for k in range(cfg.least_chars, min(cfg.most_chars, len(w)) + 1))
        if len(w) >= cfg.least_chars:
            out.add(w)
    return out


def _counted(sample: DataFrame, terms_of) -> DataFrame:
    """(term, toxic, clean): rows of each label that hold a term; counted within a task, then added up."""
    def run(batches):
        release_worker()
        seen = (Counter(), Counter())
        for b in batches:
            for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                seen[y].update(terms_of(t or ""))
        terms = list(seen[0].keys() | seen[1].keys())
        for at in range(0, len(terms), 50_000):
            some = terms[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([seen[1][x] for x in some], pa.int64()),
                                              pa.array([seen[0][x] for x in some], pa.int64())], ["term", "toxic", "clean"])
        seen, terms = None, None
        release_worker()
    return sample.mapInArrow(run, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _curve(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> tuple:
    """Logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, x.T @ (y - p) - ridge * w)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, cfg: FitConfig = FitConfig()) -> Model:
    """Learn from the labelled rows given (leave held-out ones out before)."""
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).select(
        "doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(cfg.fit_rows)
    rows = [tuple(r) for r in chosen.collect()]      # at most fit_rows pairs of numbers
    n_toxic = sum(y for _, y in rows)
    n_clean = len(rows) - n_toxic
    if not n_toxic or not n_clean:
        return Model({}, flat=float(n_toxic > 0) if rows else 0.0)
    few = F.broadcast(spark.createDataFrame(rows, "doc_id long, toxic int"))     # fit_rows bounds it
    # three passes learn from it, so it is cut once
    sample = cut_lineage(docs.select("doc_id", "text").join(few, "doc_id").select("text", "toxic"))

    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    terms = _counted(sample, lambda t: _starts(fold(t), cfg)).where(F.col("toxic") >= cfg.least_rows) \
        .withColumn("odds", odds).where(F.col("odds") - 1.5 * spread >= cfg.least_odds)
    top = terms.orderBy(F.desc("odds"), "term").limit(cfg.most_entries).select("term", "toxic", "clean", "odds").collect()
    lexicon: dict[str, float] = {}
    best: dict[str, tuple] = {r.term: (r.toxic, r.clean, r.odds) for r in top}
    for term in sorted(best, key=lambda w: (len(w), w)):
        shorter = [lexicon.get(term[:k]) for k in range(cfg.least_chars, len(term))]
        if not any(v is not None and v >= best[term][2] - 1.0 for v in shorter):
            lexicon[term] = best[term][2]

    plain = Model(lexicon)

    def phrases_of():
        made = []

        def of(t):
            if not made:
                made.append(Matcher(plain))
            folded = fold(t)
            return {" ".join(p) for s, _ in made[0].matches(folded) for p in made[0].phrases(folded, s)}
        return of

    safe = _counted(sample, phrases_of()).where((F.col("toxic") == 0) & (F.col("clean") >= cfg.exception_rows)) \
        .orderBy(F.desc("clean"), "term").limit(cfg.most_entries).collect()
    model = Model(lexicon, frozenset(tuple(r.term.split(" ", 1)) for r in safe))
    points = np.array([[r.x, r.y, r.toxic] for r in _features(sample, model).collect()])    # at most fit_rows, or their repeats
    if not len(points):
        return Model({}, flat=0.0)      # no labelled document is there
    return Model(lexicon, model.exceptions, _curve(points[:, :2], points[:, 2]))


def _features(sample: DataFrame, model: Model) -> DataFrame:
    def run(batches):
        m = Matcher(model)
        for b in batches:
            f = [m.features(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in f], pa.float64()), pa.array([y for _, y in f], pa.float64()),
                                              b.column("toxic")], ["x", "y", "toxic"])
    return sample.mapInArrow(run, "x double, y double, toxic int")


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """The same rows with ``name``, a score from 0 to 1, in place of a column of that name, if any."""
    there = [c for c in docs.columns if c != name]

    def run(batches):
        release_worker()
        m = Matcher(model)
        for b in batches:
            s = pa.array([m.score(t or "") for t in b.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, s], [*there, name])
        give_back()

    schema = docs.select(*there).schema
    return docs.select(*there).mapInArrow(run, type(schema)(list(schema.fields)).add(name, "double"))
