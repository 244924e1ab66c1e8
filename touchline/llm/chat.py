"""Chat formatting from event logs: fold the events of a conversation, then render it.

Events carry (conv_id, seq, turn, kind, role, text). ``message`` sets a turn's text, ``edit``
replaces it and ``regenerate`` starts it anew, both dropping all later turns known so far;
``delta`` appends streamed text. Events are folded by sequence with window functions; the
same event delivered twice counts once. Null texts and roles are empty, null conversation ids
form one conversation, ties of the sequence fold in order of kind and text, and an empty log
gives no conversation.

Rendering marks each turn and escapes text so that no control string survives inside it:
backslashes are doubled and a backslash is put after every ``<`` and ``[``. Dropping each
backslash that escapes gives the text back. A conversation is one output row, so its turns
meet in one group by definition; conversations are spread over all tasks. The work on one grows
with its length: places of turns are running sums, and masked texts are cut out of equal chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import text_or_empty

OPEN, SPLIT, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"
RESETS = ("edit", "regenerate")
CHUNK = 4096  # code points looked through for the ends of one masked text
STREAMED = 400  # code points of a streamed piece


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), r"([<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.?)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, turn, role, text, one row per surviving turn."""
    log = events.select(
        "conv_id", "seq", "turn", "kind", text_or_empty(F.col("role")).alias("role"), text_or_empty(F.col("text")).alias("text")
    ).distinct()
    order = [F.col("seq"), F.col("kind"), F.col("text")]
    # An edit or regeneration voids what was logged before it for its own and later turns.
    up_to = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reset = F.max(F.when(F.col("kind").isin(*RESETS), F.col("seq"))).over(up_to)
    live = log.withColumn("reset", reset).filter(F.col("reset").isNull() | (F.col("seq") >= F.col("reset")))
    # Within a turn the last full text counts, and the deltas after it.
    turn = Window.partitionBy("conv_id", "turn").orderBy(*order)
    numbered = live.withColumn("n", F.row_number().over(turn))
    full = F.when(F.col("kind") != "delta", F.col("n"))
    from_full = F.coalesce(F.max(full).over(Window.partitionBy("conv_id", "turn")), F.lit(0))
    parts = numbered.withColumn("base", from_full).filter(F.col("n") >= F.col("base"))
    return parts.groupBy("conv_id", "turn").agg(
        F.min_by("role", "n").alias("role"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "text"))), lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, mask: spans (start, end) of the escaped texts that are trained on."""
    turns = messages.select(
        "conv_id", "turn", escape(F.col("role")).alias("role"), escape(F.col("text")).alias("text"),
        (F.col("role") == TRAINED_ROLE).alias("on"),
    ).withColumn("whole", F.concat(F.lit(OPEN), "role", F.lit(SPLIT), "text", F.lit(CLOSE)))
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "text", "on").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.length("whole")).over(so_far).cast("int") - len(CLOSE)
    placed = turns.withColumn("end", end).withColumn("start", F.col("end") - F.length("text"))
    return placed.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "whole"))), lambda t: t["whole"]), "").alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("on"), F.struct("start", "end")))).alias("mask"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation: array of (role, text)."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def turn(b: Column) -> Column:
        sides = F.split(F.substring(b, F.lit(len(OPEN) + 1), F.length(b)), r"<\|im_sep\|>")
        return F.struct(unescape(sides[0]).alias("role"), unescape(sides[1]).alias("text"))

    return F.transform(blocks, turn)


def read_back(rendered: DataFrame) -> DataFrame:
    """Digest columns, all taken from the formatted text and its mask."""

    def cut(chunks: Column, span: Column) -> Column:
        first, last = F.floor(span["start"] / CHUNK).cast("int"), F.floor(span["end"] / CHUNK).cast("int")
        near = F.array_join(F.slice(chunks, first + 1, last - first + 1), "")
        return F.substring(near, span["start"] - first * CHUNK + 1, span["end"] - span["start"])

    # An array of one, so that the chunks are made once and not for every span.
    chunked = F.array(F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)))
    masked = F.transform(
        chunked, lambda chunks: F.array_join(F.transform("mask", lambda s: unescape(cut(chunks, s))), "")
    )[0]
    return rendered.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), masked.alias("loss")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256
        ).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def events_of(conversations: DataFrame, streamed: int = STREAMED) -> DataFrame:
    """The event log of a turn table, each row a turn of its own, also where turns repeat.

    Assistant rows are logged as a model's replies come: a regeneration, which voids whatever was
    there, and deltas of at most ``streamed`` code points. Other rows are one message each.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = conversations.select("conv_id", F.row_number().over(order).cast("long").alias("turn"), "role", "text")
    pieces = F.regexp_extract_all(text_or_empty(F.col("text")), F.lit(f"(?s).{{1,{streamed}}}"), F.lit(0))
    reply = F.concat(F.array(F.lit("")), pieces)
    first = F.when(F.col("role") == TRAINED_ROLE, "regenerate").otherwise("message")
    logged = turns.select(
        "conv_id", "turn", "role", first.alias("first"),
        F.posexplode(F.when(F.col("role") == TRAINED_ROLE, reply).otherwise(F.array("text"))).alias("n", "text"),
    )
    return logged.select(
        "conv_id", (F.col("turn") * (1 << 32) + F.col("n")).alias("seq"),
        F.when(F.col("n") == 0, F.col("first")).otherwise("delta").alias("kind"), "role", "text", "turn",
    )
