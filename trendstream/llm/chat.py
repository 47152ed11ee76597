"""Chat formatting with typed content parts.

A turn's content is an array of typed parts.  ``PartVisitor`` turns one part
into Catalyst expressions: the text to write (escaped text, or one placeholder
for an image, audio clip or document), the attachment it refers to and the
number of tokens it expands to.  ``format_chat`` applies it to every part,
writes each turn between control strings and puts a conversation's turns
together; offsets are running sums, so no Python runs on the rows.

Control strings inside texts and roles are escaped reversibly: a backslash is
doubled, then every control string gets a backslash after its first character.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendstream.llm.common import quoted, text_or_empty

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
CONTROLS = (TURN, SAYS, END, *PLACEHOLDERS.values(), "<s>", "</s>", "[INST]", "[/INST]",
            "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|im_start|>", "<|im_end|>")
PART = ("array<struct<kind:string,text:string,ref:string,width:int,height:int,"
        "seconds:double,pages:int>>")
_CONTROL = "(?s)(?=" + "|".join(re.sub(r"([<>|\[\]/])", r"\\\1", c) for c in CONTROLS) + ")(.)"


def escape(text: Column) -> Column:
    doubled = F.replace(text_or_empty(text), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    none = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("kind"), text_or_empty(text).alias("text"), none.alias("ref"),
                            none.alias("width"), none.alias("height"), none.alias("seconds"),
                            none.alias("pages"))).cast(PART)


class PartVisitor:
    """Expressions of one part by its kind; tokens an attachment expands to by its size."""

    def __init__(self, patch: int = 14, audio_tokens_per_second: float = 25.0, page_tokens: int = 576):
        self.patch, self.audio_rate, self.page_tokens = patch, audio_tokens_per_second, page_tokens

    def image(self, part: Column) -> Column:
        across = F.ceil(F.coalesce(part["width"], F.lit(0)) / self.patch)
        return across * F.ceil(F.coalesce(part["height"], F.lit(0)) / self.patch)

    def audio(self, part: Column) -> Column:
        return F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.audio_rate)

    def document(self, part: Column) -> Column:
        return F.coalesce(part["pages"], F.lit(0)) * self.page_tokens

    def visit(self, part: Column) -> Column:
        """struct(piece, kind, ref, tokens); a null or unknown kind is read as text."""
        piece, tokens, kind = escape(part["text"]), F.lit(0), F.lit("text")
        for name, mark in PLACEHOLDERS.items():
            here = part["kind"] == name
            piece = F.when(here, F.lit(mark)).otherwise(piece)
            kind = F.when(here, F.lit(name)).otherwise(kind)
            tokens = F.when(here, getattr(self, name)(part)).otherwise(tokens)
        return F.struct(piece.alias("piece"), kind.alias("kind"), part["ref"].alias("ref"),
                        tokens.cast("long").alias("tokens"))


def format_chat(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                parts: str = "parts", learn: str = "assistant",
                visitor: PartVisitor | None = None) -> DataFrame:
    """One row per conversation: its formatted text and what lies where in it.

    Result: conv_id, n_turns, formatted, loss (spans of code points: the text
    parts of turns whose role is ``learn``), attachments (kind, ref, at: code
    point of its placeholder, tokens: expanded count, in order) and
    attachment_tokens.

    Turns are ordered by turn (null first), then role, then content, so repeated
    rows give repeated turns.  Null roles, texts and part lists are empty; a
    null conv_id is a conversation of its own.  An empty table gives no row.
    """
    visitor = visitor or PartVisitor()
    who = text_or_empty(F.col(quoted(role)))
    pieces = F.transform(F.coalesce(F.col(quoted(parts)), F.array().cast(PART)), visitor.visit)
    head = F.concat(F.lit(TURN), escape(who), F.lit(SAYS))
    rows = (turns.select(F.col(quoted(conv_id)).cast("long").alias("conv_id"), F.col(quoted(turn)).alias("turn"),
                         who.alias("role"), head.alias("head"), pieces.alias("pieces"))
            .withColumn("written", F.concat("head", F.array_join("pieces.piece", ""), F.lit(END))))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "written")
    rows = rows.withColumn("at", F.sum(F.length("written")).over(
        before.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "nth", F.row_number().over(before))
    rows = rows.withColumn("starts", F.transform(
        "pieces", lambda _, i: F.coalesce(F.col("at"), F.lit(0)) + F.length("head") + F.aggregate(
            F.slice(F.transform("pieces.piece", F.length), F.lit(1), i), F.lit(0), lambda s, n: s + n)))
    spans = F.arrays_zip(F.col("pieces"), F.col("starts"))
    rows = rows.select(
        "conv_id", "nth", "written",
        F.when(F.col("role") == learn, F.transform(
            F.filter(spans, lambda s: s["pieces"]["kind"] == "text"),
            lambda s: F.struct(s["starts"].cast("long").alias("start"),
                               F.length(s["pieces"]["piece"]).cast("long").alias("length")))).alias("loss"),
        F.transform(F.filter(spans, lambda s: s["pieces"]["kind"] != "text"),
                    lambda s: F.struct(s["pieces"]["kind"].alias("kind"), s["pieces"]["ref"].alias("ref"),
                                       s["starts"].cast("long").alias("at"),
                                       s["pieces"]["tokens"].alias("tokens"))).alias("attachments"))
    inorder = F.sort_array(F.collect_list(F.struct("nth", "written", "loss", "attachments")))
    return (rows.groupBy("conv_id").agg(inorder.alias("t"))
            .select("conv_id", F.size("t").cast("long").alias("n_turns"),
                    F.array_join("t.written", "").alias("formatted"),
                    F.flatten(F.filter("t.loss", lambda x: x.isNotNull())).alias("loss"),
                    F.flatten("t.attachments").alias("attachments"))
            .withColumn("attachment_tokens", F.aggregate(
                "attachments.tokens", F.lit(0).cast("long"), lambda s, n: s + n)))


def read_turns(formatted: Column) -> Column:
    """array<struct(role, text)> of a formatted conversation, unescaped."""
    def turn(part: Column) -> Column:
        halves = F.split(part, re.escape(SAYS), 2)
        return F.struct(unescape(halves[0]).alias("role"),
                        unescape(F.replace(halves[1], F.lit(END), F.lit(""))).alias("text"))
    parts = F.split(formatted, re.escape(TURN))
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
