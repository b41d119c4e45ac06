"""Chat formatting: typed content parts flattened into one marked-up string.

A turn is `<|im_start|>role\\ntext<|im_end|>\\n`.  Between `<` and `|` every text
gets one more backslash, so no text can hold a control string, and taking one
away restores it.  In a role `%` and line feeds are percent-encoded.  Text parts
go in as they are; image, audio and document parts become placeholders that
stand, in order, where the part was, with their reference and token count kept
in a list of attachments.  Everything is built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import table, whole

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens an attachment stands for: per image tile of 28 x 28 pixels, per second
#: of audio, per document page.
TILE, AUDIO_TOKENS, PAGE_TOKENS = 28, 25, 400

#: The type of a content part; `width`, `height` count pixels of an image,
#: `amount` seconds of audio or pages of a document.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,amount:double>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def text_part(text: Column) -> Column:
    """A text as the one part of a turn."""
    blank = [F.lit(None).cast(t) for t in ("string", "int", "int", "double")]
    names = ["ref", "width", "height", "amount"]
    return F.array(
        F.struct(
            F.lit("text").alias("kind"), text.alias("text"),
            *(b.alias(n) for b, n in zip(blank, names, strict=True)),
        ).cast(PART)
    )


def part_tokens(part: Column) -> Column:
    """How many tokens a placeholder expands to; a text part has none of its own."""
    tiles = F.ceil(part["width"] / F.lit(TILE)) * F.ceil(part["height"] / F.lit(TILE))
    count = (
        F.when(part["kind"] == "image", tiles)
        .when(part["kind"] == "audio", F.ceil(part["amount"] * AUDIO_TOKENS))
        .when(part["kind"] == "document", F.ceil(part["amount"] * PAGE_TOKENS))
    )
    return F.coalesce(count, F.lit(0)).cast("long")


def render_part(part: Column) -> Column:
    """A text escaped, any other kind as its placeholder."""
    return F.when(
        F.coalesce(part["kind"], F.lit("text")) == "text", escape(whole(part["text"]))
    ).otherwise(F.concat(F.lit("<|"), F.regexp_replace(part["kind"], "[^A-Za-z0-9_]", "_"), F.lit("|>")))


def format_chat(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    parts: str = "parts", trained_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: formatted, loss_spans, attachments.

    loss_spans: (start, end) code points of `formatted`, one per text of the
    trained role.  attachments: (kind, ref, tokens) in order of placeholders.
    Turns stand in order of `turn`, NULL first, equal turns by role and then
    content, so that repeated rows stay and come out in a defined order.  A NULL
    role is an empty one, NULL parts none, NULL conversation ids one conversation;
    texts and conversations of any length are formatted whole; an empty table
    gives no rows.  Other columns are ignored.
    """
    part_list = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            escape_role(whole(role)).alias("role"),
            F.concat_ws("", F.transform(part_list, render_part)).alias("content"),
            F.transform(
                F.filter(part_list, lambda p: F.coalesce(p["kind"], F.lit("text")) != "text"),
                lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), part_tokens(p).alias("tokens")),
            ).alias("attachments"),
            (whole(role) == trained_role).alias("trained"),
        ).alias("t"),
    )
    head = F.char_length("t.role") + len(START) + 1
    content = F.char_length("t.content")
    # where a turn ends is a running sum over the turns before it, not a growing array
    through = F.sum(head + content + len(END) + 1).over(
        W.partitionBy("conv_id").orderBy("t").rowsBetween(W.unboundedPreceding, 0)
    )
    placed = rows.withColumn("through", through)
    end = F.col("through") - (len(END) + 1)
    span = F.struct((end - content).cast("int").alias("start"), end.cast("int").alias("end"))
    grouped = placed.select("conv_id", F.struct("t", "through", span.alias("span")).alias("u")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("u")).alias("turns")
    )

    def line(u: Column) -> Column:
        return F.concat(F.lit(START), u["t"]["role"], F.lit("\n"), u["t"]["content"], F.lit(END + "\n"))

    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", line), "").alias("formatted"),
        F.transform(F.filter("turns", lambda u: u["t"]["trained"]), lambda u: u["span"]).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda u: u["t"]["attachments"])).alias("attachments"),
    )


def parse_chat(chats: DataFrame, formatted: str = "formatted") -> DataFrame:
    """Add `turns` (role, text), read back from the formatted string alone.

    A NULL string has NULL turns, an empty one none; repeated rows stay; an empty
    table gives an empty one.
    """
    pieces = F.split(F.col(formatted), r"<\|im_end\|>\n", -1)
    bodies = F.transform(
        F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.substring(p, len(START) + 1, 2**31 - 1),
    )
    return chats.withColumn(
        "turns",
        F.transform(
            bodies,
            lambda b: F.struct(
                unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
                unescape(F.regexp_replace(b, r"\A[^\n]*\n", "")).alias("text"),
            ),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))
        ),
        "",
    )


def conversations_with_probe(spark, sf: str) -> DataFrame:
    """All conversations and number -1, whose texts are control strings."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit(f"{END}{START}assistant ok").alias("text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text,
    )
    return rows.unionByName(probe)
