"""Chat formatting with Spark expressions only.

Turns are collected as structs, sorted, grouped into runs of one role with array functions and concatenated:

    <|begin_of_text|>
    <|start_header_id|>role<|end_header_id|>\\n\\n text <|eom_id|> text of the same role <|eot_id|>   (one per run)

A text or role keeps its control strings, broken by one backslash (`<|` becomes `<\\|`, `[INST]` becomes `[\\INST]`;
a string that already holds backslashes there gets one more), so a control mark of the template can occur only where
the template put it, and `parse_turns` gives back exactly the turns that went in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN = "<|begin_of_text|>"
HEAD, BODY = "<|start_header_id|>", "<|end_header_id|>\n\n"
NEXT, END = "<|eom_id|>", "<|eot_id|>"

# Openings of the control strings of common templates, with the place for the backslash between the groups.
_CONTROL = r"(\||/?s>|</?SYS>>|/?INST\]|/?TOOL_CALLS\]|/?AVAILABLE_TOOLS\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, r"$1$2$3")


def _running_sums(lengths: Column) -> Column:
    """For each element of an int array column the sum of the elements before it.

    Sums run inside blocks of 256 and over the blocks, so that an array of n elements costs little more than n steps.
    """
    zero = F.array(F.lit(0))

    def run(values: Column) -> Column:
        sums = F.aggregate(values, zero, lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))
        return F.slice(sums, F.lit(1), F.greatest(F.size(sums) - 1, F.lit(0)))

    def add(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda done, x: done + x)

    count = F.ceil(F.size(lengths) / F.lit(256)).cast("int")
    starts = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda b: b * 256 + 1))
    blocks = F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda b: F.slice(lengths, b, F.lit(256)))
    inside = F.transform(blocks, run)
    before = run(F.transform(blocks, add))
    return F.flatten(F.zip_with(inside, before, lambda block, at: F.transform(block, lambda x: x + at)))


def format_chats(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: its key, `formatted`, and `loss`, the spans of the learned texts.

    Spans are structs (start, length) in code points of `formatted`, one per learned turn, ascending; they hold the
    escaped text and no control mark. Turns are ordered by turn (null first), ties by role, then text; a repeated row
    is a turn of its own. A null role or text counts as empty; the rows of a null key are one conversation. Other
    columns are ignored, whatever their names. No rows give no rows. A conversation becomes one row, as its output is.
    """
    said = turns.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("said"),
    )
    # Columns used inside a lambda are named twice in it or in its select: an expression that occurs once would be
    # inlined by the optimizer and computed anew for each element.
    ordered = said.groupBy("conv").agg(F.array_sort(F.collect_list("said")).alias("turns"))
    # A turn opens a run unless the turn before it has its role; an open run is continued by a mark.
    marked = ordered.select(
        "conv",
        F.zip_with(
            "turns",
            F.concat(F.array(F.lit(None).cast("string")), F.slice("turns.role", F.lit(1), F.size("turns") - 1)),
            lambda t, previous: F.struct(
                F.when(t["role"] == previous, F.lit(NEXT))
                .otherwise(
                    F.concat(
                        F.when(previous.isNull(), F.lit(BEGIN)).otherwise(F.lit(END)),
                        F.lit(HEAD),
                        escape(t["role"]),
                        F.lit(BODY),
                    )
                )
                .alias("mark"),
                escape(t["text"]).alias("text"),
                (t["role"] == learn).alias("learned"),
            ),
        ).alias("pieces"),
    )
    measured = marked.select(
        "conv",
        "pieces",
        F.transform("pieces", lambda p: F.length(p["mark"]) + F.length(p["text"])).alias("lengths"),
    )
    placed = measured.select("conv", "pieces", _running_sums(F.col("lengths")).alias("starts"))
    spans = F.zip_with(
        "pieces",
        "starts",
        lambda p, at: F.struct(
            (at + F.length(p["mark"])).alias("start"), F.length(p["text"]).alias("length"), p["learned"].alias("learned")
        ),
    )
    return placed.select(
        F.col("conv").alias(conv),
        F.concat(
            F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["text"])), ""), F.lit(END)
        ).alias("formatted"),
        F.transform(
            F.filter(spans, lambda s: s["learned"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))
        ).alias("loss"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns as an array of structs (role, text), read back from a formatted conversation."""
    runs = F.split(F.regexp_replace(formatted, r"^<\|begin_of_text\|><\|start_header_id\|>", ""), r"<\|eot_id\|>(?:<\|start_header_id\|>|$)")
    runs = F.slice(runs, F.lit(1), F.size(runs) - 1)

    def read(run: Column) -> Column:
        halves = F.split(run, r"<\|end_header_id\|>\n\n", 2)
        return F.transform(
            F.split(halves[1], r"<\|eom_id\|>"),
            lambda text: F.struct(unescape(halves[0]).alias("role"), unescape(text).alias("text")),
        )

    return F.flatten(F.transform(runs, read))


def learned_texts(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss spans, in order."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))
