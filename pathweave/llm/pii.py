"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts the score.

Everything is a DataFrame expression over one row; nothing is shuffled.  A
pattern's matches and the pieces between them (``regexp_extract_all`` and
``split`` with the same pattern) are zipped, and one left-to-right fold over
them gives each match its code-point offsets.  The context of a confirmed span
is cut from the whole text, so earlier spans do not hide a label from later ones.

Defined results: a null or empty text has no spans; rows are independent, so
ties, repeated rows and empty tables need no rule; a text may be of any length;
other columns are untouched.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, let, scan

# Possessive loops and the look-behinds give the same leftmost matches as the
# plain patterns (each run of characters is tried once, from its start or from
# the end of the previous match), but stay linear and off the regex stack.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?+[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# every start of an IBAN is a match of its own; the text that it may reach to, and one character more, is group 1
IBAN = r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11}(?: ?[A-Za-z0-9]){0,20}))[A-Z]{2}[0-9]{2}"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PASSPORT = r"(?<![A-Za-z0-9])[A-Z]{1,2}[0-9]{6,9}(?![A-Za-z0-9])"

# characters of an IBAN without spaces, by country
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}

IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where a string of digits passes the Luhn sum."""
    def worth(c, i):
        n = c.cast("int")
        twice = n * 2
        return F.when(i % 2 == 0, n).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    parts = F.transform(F.split(F.reverse(digits), ""), worth)
    return F.aggregate(parts, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def mod97(v: Column) -> Column:
    """True where an IBAN (spaces allowed) leaves 1 modulo 97."""
    compact = F.regexp_replace(v, " ", "")
    turned = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))
    values = F.transform(F.split(turned, ""), lambda c: F.when(c.rlike("^[0-9]$"), c.cast("int"))
                         .when(c.rlike("^[A-Z]$"), F.ascii(c) - 55))
    folded = F.aggregate(F.filter(values, lambda n: n.isNotNull()), F.lit(0),
                         lambda a, n: (a * F.when(n > 9, 100).otherwise(10) + n) % 97)
    return folded == 1


def iban_in(reach: Column) -> Column:
    """The IBAN that ``reach`` starts with, null if none.

    It ends before a character that is no letter or digit and passes mod 97:
    with the length of its country if that does, else the longest.
    """
    ends = [F.regexp_extract(reach, rf"^[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])", 0) for n in range(34, 14, -1)]
    passed = F.filter(F.array(*ends), lambda v: (F.length(v) > 0) & mod97(v))
    lengths = F.create_map(*[F.lit(x) for n, names in IBAN_LENGTHS.items() for c in names.split() for x in (c, n)])
    usual = F.filter(passed, lambda v: F.length(F.regexp_replace(v, " ", "")) == lengths[F.substring(v, 1, 2)])
    return F.coalesce(F.get(usual, F.lit(0)), F.get(passed, F.lit(0)))


def _valid_card(v: Column) -> Column:
    d = _digits(v)
    return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)


@dataclass(frozen=True)
class Kind:
    """One kind of span.

    ``seen`` is a cheap test that holds for every text with a match, ``valid``
    confirms a match, ``score`` is its score by itself and ``context`` the
    words that raise it by ``PiiConfig.context_gain`` when one stands before or after it.
    """
    name: str
    pattern: str
    seen: str
    valid: object
    score: float
    context: str = ""
    base: bool = False
    within: object = None       # the span in what group 1 of a match reaches to, or null, where a match is only its start


KINDS = (
    Kind("email", EMAIL, "@", lambda v: F.lit(True), 0.9, "mail|contact|write to", True),
    Kind("ip", IP, r"[0-9]\.[0-9]", lambda v: v.rlike(IP_PARTS), 0.6, r"ip|host|server|address", True),
    Kind("card", CARD, r"[0-9](?:[ -]?[0-9]){12}", _valid_card, 0.8, "card|visa|credit|payment", True),
    Kind("phone", PHONE, r"\+[0-9]", lambda v: F.length(_digits(v)).between(9, 15), 0.7, "phone|tel|call|mobile", True),
    Kind("iban", IBAN, "[A-Z]{2}[0-9]{2}", lambda v: v.isNotNull(), 0.9, "iban|account|konto", within=iban_in),
    Kind("ssn", SSN, "[0-9]{3}-[0-9]{2}-[0-9]{4}", lambda v: ~v.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3,
         "ssn|social security"),
    Kind("passport", PASSPORT, "[A-Z][0-9]{6}", lambda v: F.lit(True), 0.1, "passport|pass no|reisepass"),
)


@dataclass(frozen=True)
class PiiConfig:
    kinds: tuple = field(default=KINDS)
    context_chars: int = 48     # how far before or after a span its context words may stand
    context_gain: float = 0.4
    threshold: float = 0.5      # spans of the base kinds stay whatever their score


SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


FOUND = "struct<start:bigint,value:string>"


def _apart(found: Column) -> Column:
    """Without those that start inside the one kept before."""
    free = lambda at, x: x["start"] >= at
    return scan(found, F.lit(0).cast("long"), FOUND,
                lambda at, x: F.when(free(at, x), x["start"] + F.length(x["value"])).otherwise(at),
                lambda at, x: F.when(free(at, x), F.array(x)).otherwise(F.array().cast(f"array<{FOUND}>")))


def kind_spans(text: Column, pieces: Column, kind: Kind, cfg: PiiConfig) -> Column:
    """Confirmed spans of one kind in a text, given also in pieces (``chunks``): struct(kind, start, end, score), by start."""
    parts = F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1 if kind.within else 0)).alias("value"))
    start = lambda at, x: at + F.length(x["gap"])
    found = scan(parts, F.lit(0).cast("long"), FOUND,
                 lambda at, x: start(at, x) + F.coalesce(F.length(x["hit"]), F.lit(0)),
                 lambda at, x: F.when(x["hit"].isNull(), F.array().cast(f"array<{FOUND}>")).otherwise(
                     F.array(F.struct(start(at, x).alias("start"), x["value"].alias("value")))))
    if kind.within:
        found = _apart(F.filter(F.transform(found, lambda x: F.struct(x["start"].alias("start"), kind.within(x["value"]).alias("value"))),
                                lambda x: x["value"].isNotNull()))

    def near(x):
        if not kind.context:
            return F.lit(False)
        start, end, n = x["start"], x["start"] + F.length(x["value"]), F.lit(cfg.context_chars).cast("long")
        around = cut(pieces, F.greatest(start - n, F.lit(0)), F.least(start, n)), cut(pieces, end, n)
        return around[0].rlike(rf"(?i)\b(?:{kind.context})") | around[1].rlike(rf"(?i)\b(?:{kind.context})")

    scored = F.transform(F.filter(found, lambda x: kind.valid(x["value"])), lambda x: F.struct(
        F.lit(kind.name).alias("kind"), x["start"].alias("start"),
        (x["start"] + F.length(x["value"])).alias("end"),
        F.least(F.lit(1.0), F.lit(kind.score) + F.when(near(x), cfg.context_gain).otherwise(0.0)).alias("score")))
    if not kind.base:
        scored = F.filter(scored, lambda s: s["score"] >= cfg.threshold)
    return F.when(text.rlike(kind.seen), scored).otherwise(F.array().cast(SPAN))


def find(docs: DataFrame, cfg: PiiConfig = PiiConfig(), text: str = "text", out: str = "spans") -> DataFrame:
    """Add ``out``: all spans of a text by kind as configured, then start (code points, end exclusive)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    seen = F.lit(False)
    for k in cfg.kinds:
        seen = seen | whole.rlike(k.seen)
    cut_up = docs.withColumn("__pw_pieces", F.when(seen, chunks(whole)))
    per_kind = cut_up.withColumns({f"__pw_{k.name}": kind_spans(whole, F.col("__pw_pieces"), k, cfg) for k in cfg.kinds})
    return per_kind.withColumn(out, F.concat(*[F.col(f"__pw_{k.name}") for k in cfg.kinds])) \
        .drop("__pw_pieces", *[f"__pw_{k.name}" for k in cfg.kinds])


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every run of overlapping spans replaced by the first span's ``[KIND]``."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                              s["kind"].alias("kind"))))

    def rebuilt(pieces):
        # a last span of no kind after the text takes what follows the others
        end = F.struct(F.length(text).cast("long").alias("start"), F.length(text).cast("long").alias("end"), F.lit("").alias("kind"))
        kept = scan(F.array_append(order, end), F.lit(0).cast("long"), "string", lambda at, s: F.greatest(at, s["end"]),
                    lambda at, s: F.when((s["start"] < at) & (s["kind"] != ""), F.array().cast("array<string>")).otherwise(
                        F.array(cut(pieces, at, s["start"] - at), F.when(s["kind"] == "", "").otherwise(
                            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))))
        return F.array_join(kept, "")
    return F.when(F.size(spans) == 0, text).otherwise(let(chunks(text), rebuilt))


def redact(docs: DataFrame, cfg: PiiConfig = PiiConfig()) -> DataFrame:
    """The same rows and columns with personal data masked in ``text``; null texts stay null.

    ``n_chars``, if there, is that of the masked text.
    """
    out = find(docs, cfg, out="__pw_spans").withColumn("text", masked(F.col("text"), F.col("__pw_spans")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("__pw_spans") > 0, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
