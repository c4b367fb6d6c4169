"""Chat formatting with Spark expressions only.

A conversation becomes one text.  Adjacent turns of one role are merged into
one block:

    <|im_start|>ROLE\nTEXT<|im_end|>\n
    <|im_start|>ROLE\nTEXT<|im_next|>TEXT<|im_end|>\n

Control strings inside roles and texts are escaped, so that the text can be
read back turn by turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>"
BACKSLASH = "\\"


def escape(text: Column) -> Column:
    r"""Double each backslash, then write ``<|`` as ``<\|``: no control string is left."""
    doubled = F.replace(text, F.lit(BACKSLASH), F.lit(BACKSLASH * 2))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Undo ``escape``: after a ``<`` an escaped text holds a single backslash only where one was put in."""
    plain = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(plain, F.lit(BACKSLASH * 2), F.lit(BACKSLASH))


def escape_role(role: Column) -> Column:
    r"""A role ends at its line's end, so a line break in it becomes ``<\/``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\/"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\/"), F.lit("\n")))


def format_conversations(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``formatted``, ``n_blocks`` and ``loss`` spans.

    ``loss`` is an array of (start, end) in code points, one span for the text
    of each turn of the ``trained`` role, control strings excluded.

    Turns are sorted by turn number, then role, then text, so ties and repeated
    rows always come out alike.  NULL texts and roles are empty, NULL turn
    numbers come first, rows of a NULL conversation form one conversation,
    other columns are ignored and an empty table gives an empty result.  A
    conversation is one output value, so it has to fit a task.
    """
    said = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    grouped = turns.select(F.col(conv).alias("conv"), said.alias("said")).groupBy("conv").agg(
        F.sort_array(F.collect_list("said")).alias("said")
    )
    # Each turn knows whether it opens and closes a block of its role.
    previous = F.concat(F.array(F.lit(None).cast("string")), F.col("said.role"))
    following = F.concat(F.slice(F.col("said.role"), 2, F.size("said")), F.array(F.lit(None).cast("string")))
    parts = F.transform(
        F.arrays_zip(F.col("said"), previous.alias("before"), following.alias("after")),
        lambda x: F.struct(
            F.when(
                x["before"].eqNullSafe(x["said"]["role"]), F.lit(NEXT)
            ).otherwise(F.concat(F.lit(START), escape_role(x["said"]["role"]), F.lit("\n"))).alias("head"),
            escape(x["said"]["text"]).alias("body"),
            F.when(x["after"].eqNullSafe(x["said"]["role"]), F.lit("")).otherwise(F.lit(END + "\n")).alias("tail"),
            (x["said"]["role"] == trained).alias("trained"),
        ),
    )
    # previous has one element more than there are turns; the zip's last entry has no turn.
    parts = F.slice(parts, 1, F.size("said"))
    lengths = F.transform(
        F.col("parts"),
        lambda p: F.struct(
            F.length(p["head"]).cast("long").alias("head"),
            F.length(p["body"]).cast("long").alias("body"),
            F.length(p["tail"]).cast("long").alias("tail"),
            p["trained"].alias("trained"),
        ),
    )
    span = "struct<start:bigint,end:bigint>"
    walked = F.aggregate(
        lengths,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["head"] + p["body"] + p["tail"]).alias("at"),
            F.when(
                p["trained"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + p["head"]).alias("start"), (acc["at"] + p["head"] + p["body"]).alias("end")
                        )
                    ),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    return grouped.select("conv", parts.alias("parts")).select(
        F.col("conv").alias(conv),
        F.array_join(
            F.transform("parts", lambda p: F.concat(p["head"], p["body"], p["tail"])), ""
        ).alias("formatted"),
        F.size(F.filter("parts", lambda p: p["head"] != NEXT)).cast("long").alias("n_blocks"),
        walked["spans"].alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """Parse a formatted text back into an array of (role, text), one entry per turn."""
    parts = F.split(formatted, r"<\|im_start\|>", -1)
    blocks = F.slice(parts, F.lit(2), F.size(parts) - 1)
    parsed = F.transform(
        blocks,
        lambda b: F.struct(
            unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            # From behind the role's line to the block's end mark and its line break.
            F.split(
                F.substr(
                    b,
                    F.instr(b, "\n") + 1,
                    F.length(b) - F.instr(b, "\n") - F.lit(len(END) + 1),
                ),
                r"<\|im_next\|>",
                -1,
            ).alias("texts"),
        ),
    )
    return F.flatten(
        F.transform(
            parsed,
            lambda b: F.transform(
                b["texts"], lambda t: F.struct(b["role"].alias("role"), unescape(t).alias("text"))
            ),
        )
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(
        loss,
        lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
