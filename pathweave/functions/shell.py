"""Command lines and paths as column functions (all JVM-side, no fold over characters).

A command line is cut into words by one possessive pattern, so that a long one
takes time in proportion to its length and no deep recursion; each word is then
cut into its quoted and plain pieces, which lose their quotes and escapes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: how a compile database quotes.  Only spaces part words; a backslash
# takes the next character as it is, outside quotes and in double ones; single
# quotes take all; a quote left open ends with the text.
_ESCAPED = r"\\.?+"
_DOUBLE = r'"[^"\\]*+(?:\\.?+[^"\\]*+)*+"?+'
_SINGLE = r"'[^']*+'?+"
WORD_PATTERN = rf"""(?s)(?:[^ "'\\]++|{_ESCAPED}|{_DOUBLE}|{_SINGLE})++"""
PIECE_PATTERN = rf"""(?s)[^"'\\]++|{_ESCAPED}|{_DOUBLE}|{_SINGLE}"""
UNESCAPE_PATTERN = r'(?s)\\(.)|["\\]'


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _unquote(word: Column) -> Column:
    pieces = F.regexp_extract_all(word, F.lit(PIECE_PATTERN), 0)
    plain = F.transform(pieces, lambda p: F.when(p.startswith("'"), F.translate(p, "'", ""))
                        .otherwise(F.regexp_replace(p, UNESCAPE_PATTERN, "$1")))
    return F.array_join(plain, "")


def shell_words(text) -> Column:
    """The words of a command line, without their quotes; null gives no words, ``""`` an empty word."""
    words = F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(WORD_PATTERN), 0)
    # most words hold no quote and pass as they are
    return F.transform(words, lambda w: F.when(w.rlike(r"""["'\\]"""), _unquote(w)).otherwise(w))


def normalize_path(path) -> Column:
    """A path without ``.``, ``..`` and repeated slashes, by its text alone (links are not followed).

    ``..`` above the root is dropped, above a relative start it is kept; nothing
    left gives ``/`` or ``.``; the empty path stays empty and null stays null.
    """
    p = _c(path)
    root = p.startswith("/")
    parts = F.filter(F.split(p, "/"), lambda x: (x != "") & (x != "."))

    def step(acc, x):
        can_pop = (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1)) != "..")
        return (F.when(x != "..", F.concat(acc, F.array(x)))
                .when(can_pop, F.slice(acc, 1, F.size(acc) - 1))
                .when(root, acc).otherwise(F.concat(acc, F.array(x))))
    # only paths with a ``..`` need the fold
    folded = F.when(F.array_contains(parts, ".."),
                    F.aggregate(parts, F.array().cast("array<string>"), step)).otherwise(parts)
    text = F.concat(F.when(root, "/").otherwise(""), F.array_join(folded, "/"))
    return F.when(p == "", p).when(text == "", F.lit(".")).otherwise(text)


def resolve_path(directory, path) -> Column:
    """``path`` as seen from ``directory``, normalised; an absolute path or a null directory leaves it alone."""
    d, p = _c(directory), _c(path)
    under = F.concat(d, F.lit("/"), p)
    return normalize_path(F.when(p.startswith("/") | d.isNull() | (d == "") | (p == ""), p).otherwise(under))
