"""Chat formatting: typed content parts flattened into ordered placeholders, a loss mask, and the way back.

A turn becomes ``<|turn|>role<|text|>content<|end|>``.  Its content is the
visited parts in order: text with every control string broken by a backslash
(and backslashes doubled, so that the escape can be undone; text parts side by side are one text), and one
placeholder per image, audio or document part, whose reference and expanded
token count go to ``attachments``.

A conversation is formatted in segments of ``segment_turns`` turn numbers, so
the turns of one very long conversation are put together by many tasks; the
second grouping only moves finished segments.  Loss spans are code-point
offsets within their segment.

Defined results: turns are ordered by turn number, then role and content;
null turn numbers come first, null roles and texts count as empty, null parts
are left out; repeated rows are repeated turns; rows with a null conv_id form
one conversation; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, let, scan

PARTS = ("array<struct<kind:string,text:string,ref:string,width:bigint,height:bigint,"
         "seconds:double,pages:bigint>>")


@dataclass(frozen=True)
class ChatConfig:
    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "<|end|>"
    placeholders: tuple = (("image", "<|image|>"), ("audio", "<|audio|>"), ("document", "<|document|>"))
    # control strings of other public templates; they are escaped in texts too
    foreign: tuple = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
                      "<|endoftext|>")
    trained: tuple = ("assistant",)
    patch: int = 28                  # image side in pixels per token
    audio_tokens_per_second: float = 25.0
    document_tokens_per_page: int = 1024
    segment_turns: int = 64

    def control(self) -> list[str]:
        return [self.turn, self.text, self.end, *[p for _, p in self.placeholders], *self.foreign]


def _quoted(s: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in s)


def escape(text: Column, cfg: ChatConfig) -> Column:
    broken = "|".join(f"{_quoted(c[0])}(?={_quoted(c[1:])})" for c in cfg.control())
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), broken, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """One text part, as ``parts``."""
    null = lambda t: F.lit(None).cast(t)
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), null("string").alias("ref"),
                            null("long").alias("width"), null("long").alias("height"), null("double").alias("seconds"),
                            null("long").alias("pages")))


def expanded_tokens(p: Column, cfg: ChatConfig) -> Column:
    """Tokens that the model will see in place of a part's placeholder."""
    up = lambda x: F.ceil(F.coalesce(x, F.lit(0)) / F.lit(cfg.patch))
    return F.when(p["kind"] == "image", up(p["width"]) * up(p["height"])) \
        .when(p["kind"] == "audio", F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * cfg.audio_tokens_per_second)) \
        .when(p["kind"] == "document", F.coalesce(p["pages"], F.lit(0)) * cfg.document_tokens_per_page) \
        .otherwise(0).cast("long")


def visited(parts: Column, cfg: ChatConfig) -> Column:
    """struct(content, attachments) of a turn's parts, in order; parts of unknown kinds count as text."""
    marks = F.create_map(*[F.lit(x) for pair in cfg.placeholders for x in pair])
    there = F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: p.isNotNull())
    mark = lambda p: marks[F.coalesce(p["kind"], F.lit("text"))]

    def joined(there):
        """Texts side by side are escaped as one, so that no control string comes about where they meet."""
        at = F.filter(F.transform(there, lambda p, i: F.when(mark(p).isNotNull(), i)), lambda i: i.isNotNull())
        ends = F.concat(F.array(F.lit(-1)), at, F.array(F.size(there)))

        def run(ends, j):
            first, last = F.get(ends, j), F.get(ends, j + 1)
            texts = F.transform(F.slice(there, first + 2, last - first - 1), lambda p: F.coalesce(p["text"], F.lit("")))
            return F.concat(escape(F.array_join(texts, ""), cfg), F.coalesce(mark(F.get(there, last)), F.lit("")))
        return let(ends, lambda e: F.array_join(F.transform(
            F.sequence(F.lit(0), F.size(e) - 2), lambda j: run(e, j)), ""))

    content = let(there, joined)
    media = F.filter(there, lambda p: p["kind"].isin(*[k for k, _ in cfg.placeholders]))
    return F.struct(content.alias("content"), F.transform(media, lambda p: F.struct(
        p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p, cfg).alias("tokens"))).alias("attachments"))


def format_conversations(turns: DataFrame, cfg: ChatConfig = ChatConfig()) -> DataFrame:
    """From (conv_id, turn, role, parts): conv_id, n_turns, media_tokens and ``segments`` in order,

    each a struct(formatted, loss array<struct<start,end>>, attachments).
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), visited(F.col("parts"), cfg).alias("v")) \
        .select("conv_id", "turn", F.floor(F.col("turn") / cfg.segment_turns).alias("block"), F.struct(
            "turn", "role", F.concat(F.lit(cfg.turn), escape(F.col("role"), cfg), F.lit(cfg.text)).alias("head"),
            F.col("v.content").alias("content"), F.col("v.attachments").alias("attachments")).alias("t"))
    segments = rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    span = "struct<start:bigint,end:bigint>"
    begin = lambda at, t: at + F.length(t["head"])
    stop = lambda at, t: begin(at, t) + F.length(t["content"])
    loss = scan(F.col("ts"), F.lit(0).cast("long"), span, lambda at, t: stop(at, t) + len(cfg.end),
                lambda at, t: F.when(t["role"].isin(*cfg.trained), F.array(F.struct(
                    begin(at, t).alias("start"), stop(at, t).alias("end")))).otherwise(F.array().cast(f"array<{span}>")))

    segments = segments.select(
        "conv_id", "block", F.size("ts").cast("long").alias("n"),
        F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["content"], F.lit(cfg.end))), "").alias("formatted"),
        loss.alias("loss"),
        F.flatten(F.transform("ts", lambda t: t["attachments"])).alias("attachments"))
    whole = segments.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum(F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])).alias("media_tokens"),
        F.array_sort(F.collect_list(F.struct("block", "formatted", "loss", "attachments"))).alias("segments"))
    return whole.withColumn("segments", F.transform("segments", lambda s: s.dropFields("block")))


def read_turns(segments: Column, cfg: ChatConfig = ChatConfig()) -> Column:
    """array<struct<role,text>> parsed from the formatted segments alone."""
    def turns(s):
        ended = F.split(s["formatted"], _quoted(cfg.end), -1)
        return F.transform(F.slice(ended, 1, F.size(ended) - 1), lambda x: F.struct(
            unescape(F.substring_index(x, cfg.text, 1).substr(F.lit(len(cfg.turn) + 1), F.length(x))).alias("role"),
            unescape(x.substr(F.length(F.substring_index(x, cfg.text, 1)) + len(cfg.text) + 1, F.length(x))).alias("text")))
    return F.flatten(F.transform(segments, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    def of(s):
        return let(chunks(s["formatted"]), lambda pieces: F.transform(s["loss"], lambda p: unescape(
            cut(pieces, p["start"], p["end"] - p["start"]))))
    return F.array_join(F.flatten(F.transform(segments, of)), "")
