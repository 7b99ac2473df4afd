"""Secret scan over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over lower-case
trigrams that every match must contain.  A task reads its rows in segments of at most
``segment_rows`` rows and, but for a longer single text, ``segment_chars``
characters; for each segment it builds an index of all distinct trigrams of its
texts, in one pass over each text (trigram -> ascending row numbers), looks up
those that the queries name, intersects and unites their postings, and runs a
rule's expression only over the rows left.  Rules without a mandatory trigram
scan every row.  A segment's index lives only as long as the segment, like one
segment of a search index, so memory is bounded by the segment and the longest
text, nothing is shuffled, and a lost task just reads its rows again.

Defined results: a null or empty text has no spans; offsets are code points,
end exclusive; rows are independent (ties and repeated rows need no rule); an
empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A rule's spans are the leftmost non-overlapping matches whose ``group`` has ``least`` characters or more."""
    name: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("live_key", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{6,}\.eyJ[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{6,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)

ALL = ("all",)           # the query that every row answers
MOST_STRINGS = 64        # literal alternatives followed at once


def _both(a, b):
    return b if a == ALL else a if b == ALL else ("and", a, b)


def _either(queries):
    each = list(dict.fromkeys(queries))
    return ALL if ALL in each else each[0] if len(each) == 1 else ("or", *each)


def _held(strings: set[str]):
    """Query of texts that contain one of the strings."""
    if any(len(s) < 3 for s in strings):
        return ALL
    return _either(reduce(_both, (("tri", s[i:i + 3]) for i in range(len(s) - 2))) for s in sorted(strings))


def _walk(parsed, strings: set[str], query):
    """Follow a parsed expression: a match so far ends with one of ``strings`` and answers ``query``."""
    for code, arg in parsed:
        one = None
        if code is op.LITERAL:
            one = {chr(arg).lower()}
        elif code is op.IN and len(arg) <= 8 and all(c is op.LITERAL for c, _ in arg):
            one = {chr(a).lower() for _, a in arg}
        if one is not None:
            if len(strings) * len(one) > MOST_STRINGS:
                strings, query = {""}, _both(query, _held(strings))
            strings = {a + b for a in strings for b in one}
        elif code is op.SUBPATTERN:
            strings, query = _walk(arg[-1], strings, query)
        elif code is op.BRANCH:
            ways = [_walk(way, strings, ALL) for way in arg[1]]
            strings = set().union(*(s for s, _ in ways))
            query = _both(query, _either(q for _, q in ways))
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[:2] == (0, 1):
            more, _ = _walk(arg[2], strings, ALL)
            strings = strings | more
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[0] > 0:
            strings, query = _walk(arg[2], strings, query)
            if arg[1] != 1:         # once for certain; what follows need not stand next to it
                strings, query = {""}, _both(query, _held(strings))
        elif code not in (op.AT, op.ASSERT, op.ASSERT_NOT):
            strings, query = {""}, _both(query, _held(strings))
    return strings, query


def trigram_query(pattern: str):
    """Boolean query over lower-case trigrams that every text with a match of the pattern answers."""
    strings, query = _walk(_parser.parse(pattern, re.ASCII), {""}, ALL)
    return _both(query, _held(strings))


def trigrams(query) -> set[str]:
    return {query[1]} if query[0] == "tri" else set().union(*map(trigrams, query[1:])) if query != ALL else set()


def answer(query, postings: SegmentIndex, rows: int) -> np.ndarray:
    """Row numbers that answer the query, ascending."""
    if query == ALL:
        return np.arange(rows)
    if query[0] == "tri":
        return postings[query[1]]
    parts = [answer(q, postings, rows) for q in query[1:]]
    if query[0] == "or":
        return reduce(np.union1d, parts)
    return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted(parts, key=len))


CODE_BITS = 21           # a code point; a trigram is one integer of three
BLOCK_CHARS = 1_000_000  # characters of one text whose trigrams are listed at a time


def trigram_code(trigram: str) -> int:
    a, b, c = map(ord, trigram)
    return a << 2 * CODE_BITS | b << CODE_BITS | c


def text_trigrams(folded: str) -> np.ndarray:
    """The distinct trigrams of a folded text, ascending."""
    found = np.empty(0, np.int64)
    for at in range(0, max(len(folded) - 2, 0), BLOCK_CHARS):
        c = np.frombuffer(folded[at:at + BLOCK_CHARS + 2].encode("utf-32-le"), np.uint32).astype(np.int64)
        here = np.unique(c[:-2] << 2 * CODE_BITS | c[1:-1] << CODE_BITS | c[2:])
        found = here if not len(found) else np.union1d(found, here)
    return found


class SegmentIndex:
    """Trigram postings of some texts: trigrams ascending, and beside each its rows ascending."""

    def __init__(self, folded: list[str]):
        each = [text_trigrams(t) for t in folded]
        grams = np.concatenate(each) if each else np.empty(0, np.int64)
        rows = np.repeat(np.arange(len(each), dtype=np.int32), [len(e) for e in each])
        order = np.argsort(grams, kind="stable")     # rows stay ascending within a trigram
        self.trigrams, self.rows = grams[order], rows[order]

    def __getitem__(self, trigram: str) -> np.ndarray:
        code = trigram_code(trigram)
        return self.rows[np.searchsorted(self.trigrams, code, "left"):np.searchsorted(self.trigrams, code, "right")]


def segments(sizes: list[int], rows: int, chars: int):
    """Consecutive (start, stop) of at most ``rows`` texts and ``chars`` characters; a longer text stands alone."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (i - start == rows or held + n > chars):
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, segment_rows: int = 512,
         segment_chars: int = 2_000_000) -> DataFrame:
    """(doc_id, spans): array<struct<kind,start,end>> by start, then rule as listed."""
    queries = [trigram_query(r.pattern) for r in rules]

    def run(batches):
        compiled = [re.compile(r.pattern, re.ASCII) for r in rules]
        for batch in batches:
            # bytes, which bound the characters
            sizes = [n or 0 for n in pc.binary_length(batch.column("text")).to_pylist()]
            for start, stop in segments(sizes, segment_rows, segment_chars):
                part = batch.slice(start, stop - start)
                texts = [t or "" for t in part.column("text").to_pylist()]
                postings = SegmentIndex([t.lower() for t in texts])
                found = [[] for _ in texts]
                for k, (rule, expr, query) in enumerate(zip(rules, compiled, queries)):
                    for i in answer(query, postings, len(texts)):
                        found[i] += [(m.start(), k, m.end()) for m in expr.finditer(texts[i])
                                     if m.end(rule.group) - m.start(rule.group) >= rule.least]
                spans = [[{"kind": rules[k].name, "start": a, "end": b} for a, k, b in sorted(f)] for f in found]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, SPANS)], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                s["end"].cast("string"))), ",")
