"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as
context, and only its own text under the loss mask. What follows the last
assistant turn (or a conversation without one) comes as a closing example
without a target, so the turns can be read back in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's control strings and the escapes that keep them out of texts.
OPEN, CLOSE, END = "<turn ", ">", "</turn>"
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), (">", "\\g"))
TARGET_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """The text without any control string in it; ``unescaped`` undoes it."""
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    # A doubled backslash is one character; what stands between has single escapes only.
    parts = F.split(text, r"\\\\", -1)

    def plain(part: Column) -> Column:
        for original, safe in ESCAPES[1:]:
            part = F.replace(part, F.lit(safe), F.lit(original))
        return part

    return F.array_join(F.transform(parts, plain), "\\")


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id: its longest example as ``text`` and a struct of ``marks`` per turn.

    ``turns`` has (conv_id, turn, role, text). All examples of a conversation are
    prefixes of its longest, so a mark has the place of its turn (from 1), where the
    turn begins and ends in the text, whether an example ends there, and the loss mask
    (loss_start, loss_length: characters, 0 and 0 without target).
    Turns are ordered by turn, nulls first, equal ones by role and text; repeated rows
    are turns of their own. Null text or role is empty, null conv_id is a conversation.
    A row has every turn once: under 2 GB of text is what a conversation may have.
    An empty table gives no rows; further columns are not read.
    """
    parts = turns.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    rendered = parts.select(
        "conv_id", "turn", "role", "text",
        F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(CLOSE)).alias("head"),
        escaped(F.col("text")).alias("body"),
    ).withColumn("size", (F.char_length("head") + F.char_length("body") + len(END)).cast("long"))
    placed = rendered.select(
        "conv_id",
        F.row_number().over(order).alias("place"),
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("last"),
        "size", "head", "body", (F.col("role") == TARGET_ROLE).alias("target"),
    )
    collected = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(
            "place",
            F.concat("head", "body", F.lit(END)).alias("block"),
            (F.col("last") - F.col("size")).alias("first"),
            "last",
            "target",
            F.when(F.col("target"), F.col("last") - F.col("size") + F.char_length("head")).otherwise(0).alias("loss_start"),
            F.when(F.col("target"), F.char_length("body")).otherwise(0).alias("loss_length"),
        ))).alias("turns")
    ).withColumn("n", F.size("turns"))
    return collected.select(
        "conv_id",
        F.array_join("turns.block", "").alias("text"),
        F.transform(
            "turns",
            lambda t: F.struct(
                t["place"].alias("place"), t["first"].alias("first"), t["last"].alias("last"), t["target"].alias("target"),
                (t["target"] | (t["place"] == F.col("n"))).alias("example"),
                t["loss_start"].alias("loss_start"), t["loss_length"].alias("loss_length"),
            ),
        ).alias("marks"),
    )


def expanded(formatted: DataFrame) -> DataFrame:
    """A row per example of ``conversations``, each with its own text: all turns before its reply, and this.

    conv_id, number (from 0), text, loss_start, loss_length, longest (whether it holds every turn).
    """
    # Filtered inside the explode, which then gives a row at a time; ahead of it, all examples of
    # a conversation are held at once.
    ends = F.filter("marks", lambda m: m["example"])
    return formatted.select("conv_id", "text", F.size(ends).alias("n"), F.posexplode(ends).alias("number", "mark")).select(
        "conv_id", "number",
        F.col("text").substr(F.lit(1), F.col("mark.last").cast("int")).alias("text"),
        "mark.loss_start", "mark.loss_length",
        (F.col("number") == F.col("n") - 1).alias("longest"),
    )


def examples(turns: DataFrame) -> DataFrame:
    """A row per example: conv_id, number (from 0), text, loss_start, loss_length."""
    return expanded(conversations(turns)).drop("longest")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the examples of each conversation say, taken from their texts and masks.

    Every example is read: what its mask leaves of its text, and how long that is. The turns
    are those of the longest.
    """
    blocks = F.filter(F.split("text", END, -1), lambda b: b != "")
    said = F.transform(
        blocks,
        lambda b: F.concat(
            unescaped(F.substring_index(F.substring(b, len(OPEN) + 1, 2147483647), CLOSE, 1)),
            F.lit("\n"),
            unescaped(F.substring_index(b, CLOSE, -1)),
            F.lit("\n"),
        ),
    )
    # Each mask is unescaped alone: replies never run into each other.
    begin = (F.col("loss_start") + 1).cast("int")
    read = expanded(formatted).select(
        "conv_id", "number",
        F.char_length("text").cast("long").alias("n_chars"),
        unescaped(F.col("text").substr(begin, F.col("loss_length"))).alias("learned"),
        F.when(F.col("longest"), F.size(blocks).cast("long")).alias("n_turns"),
        F.when(F.col("longest"), F.sha2(F.array_join(said, ""), 256)).alias("turns_sha256"),
    )
    # The rows of a conversation never left their partition.
    together = read.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_sort(F.collect_list(F.struct("number", "learned"))).alias("learned"),
        F.sum("n_chars").alias("formatted_chars"),
    ).withColumn("learned", F.array_join("learned.learned", ""))
    return together.select(
        "conv_id", "n_turns", "turns_sha256",
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )
