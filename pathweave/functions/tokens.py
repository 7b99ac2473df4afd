"""Word-level column functions (all JVM-side, no Python UDF).

Fixed values that must equal the reference's for equal output are kept
together below, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must match the reference) --------------------------------
BINARY_OPERATORS = ["+", "-", "*", "/", "%", "&", "|"]
UNARY_OPERATORS = ["++", "--"]
COMPARISON_OPERATORS = ["==", "<=", ">=", "<", ">", "!=", "&&", "||"]
ASSIGNMENT_OPERATORS = ["=", "+=", "-=", "*=", "/=", "%=", "&=", "|="]
SUBTOKEN_PATTERN = "[a-z]+|[A-Z]+[a-z]*|[0-9.]+|[-*/&|%=()]+"
OPERATOR_SPELLING_ALIASES = {
    "|": "OPERATOR_BINARY_OR",
    "||": "OPERATOR_LOGICAL_OR",
    "|=": "OPERATOR_ASSIGN_OR",
    ",": "OPERATOR_COMMA",
}
SOS, EOS, PAD, UNK = "<S>", "</S>", "<PAD>", "<UNK>"
ILLEGAL_NAMES = [UNK, PAD, EOS]
BAR = "|"
# -----------------------------------------------------------------------------

OPERATOR_TOKENS = BINARY_OPERATORS + UNARY_OPERATORS + COMPARISON_OPERATORS + ASSIGNMENT_OPERATORS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_operator_token(tok) -> Column:
    """True for one of the operator spellings; null input gives null."""
    return _c(tok).isin(OPERATOR_TOKENS)


def fix_operator_spelling(op) -> Column:
    op = _c(op)
    expr = op
    for k, v in reversed(list(OPERATOR_SPELLING_ALIASES.items())):
        expr = F.when(op == F.lit(k), F.lit(v)).otherwise(expr)
    return expr


def subtokens(name) -> Column:
    """All regex pieces of a name, case kept (``_`` never matches, so it splits)."""
    return F.regexp_extract_all(_c(name), F.lit(SUBTOKEN_PATTERN), 0)


def tokenize(name, max_subtokens: int = 5) -> Column:
    """Operators stay whole; else regex pieces cut to ``max_subtokens`` (0 = all).

    An empty result marks a name that cannot be tokenised (the caller rejects it).
    """
    name = _c(name)
    pieces = subtokens(name)
    if max_subtokens:
        pieces = F.slice(pieces, 1, max_subtokens)
    return F.when(is_operator_token(name), F.array(name)).otherwise(pieces)


def join_subtokens(arr) -> Column:
    """Bar-joined key; an empty list gives the empty string."""
    return F.array_join(_c(arr), BAR)


def token_or_subtokens(label, is_reserved, max_subtokens: int) -> Column:
    """Reserved labels stay whole, others are split into subtokens."""
    return F.when(_c(is_reserved), F.array(_c(label))).otherwise(tokenize(label, max_subtokens))


def normalize_word(word) -> Column:
    """Letters only, lower case; nothing left gives the lower-cased original."""
    w = _c(word)
    stripped = F.regexp_replace(w, "[^a-zA-Z]", "")
    return F.when(F.length(stripped) == 0, F.lower(w)).otherwise(F.lower(stripped))


def is_legal_name(word) -> Column:
    return ~_c(word).isin(ILLEGAL_NAMES)


def filter_legal_names(arr) -> Column:
    return F.filter(_c(arr), lambda x: ~x.isin(ILLEGAL_NAMES))


def base_name(path) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def is_object_file(path) -> Column:
    """``.o.`` inside the base name, or a base name ending in ``.o``."""
    name = base_name(path)
    return name.contains(".o.") | name.endswith(".o")
