"""Multi-party perspective rotation of dialogues.

Every participant of a dialogue gets a rendering of all of it: that participant speaks as
the assistant, everyone else as a named user, and the loss mask covers what the assistant
says. Renderings come in windows of a bounded number of turns, so that a dialogue of any
length is whole without being a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocked_prefix, written

START, END = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
#: What a name spells as its code, so that no two roles have one name: blanks, the mark's sign, the code's own.
ESCAPED = "% \t\n\x0b\f\r<"


def _plain(text: Column) -> Column:
    """Text in which the control marks of the format can't occur."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|(im_start|im_end)\|>", "<$1>")


def _name(role: Column) -> Column:
    for c in ESCAPED:
        role = F.replace(role, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.coalesce(F.concat(F.lit(" name="), role), F.lit(""))


def rotate_perspectives(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text", window_turns: int = 64) -> DataFrame:
    """One row per dialogue, participant and window: conv, participant, window, n_turns,
    text, loss_spans (array of start and stop, in characters of text, stop excluded).

    Participants are the distinct roles but the system and null; a null role speaks as a
    user without a name. Different roles have different names: blanks, "%" and "<" in them are
    spelled as their codes, like %20. Turns are ordered by turn (null first), then role, then text; repeated
    rows are turns of their own. Null texts are empty turns, rendered as such. A null
    dialogue id is one dialogue. The assistant's span covers its text and the closing
    mark; a window without any has no span. Dialogues without a participant give no row,
    and so does an empty table. Long turns are rendered whole.
    """
    turns = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                      F.col(text_col).alias("text"), F.lit(1).alias("one"))
    turns = blocked_prefix(turns, ["conv"], ["turn", "role", "text"], "one", "at").drop("one")
    people = written(turns.where(F.col("role").isNotNull() & (F.col("role") != SYSTEM))
                     .select(F.col("conv").alias("p_conv"), F.col("role").alias("participant")).distinct(),
                     "participants")
    own = F.col("role").eqNullSafe(F.col("participant"))
    head = (F.when(F.col("role") == SYSTEM, F.lit(f"{START}{SYSTEM}\n"))
            .when(own, F.lit(f"{START}assistant\n"))
            .otherwise(F.concat(F.lit(f"{START}user"), _name(F.col("role")), F.lit("\n"))))
    body = F.concat(_plain(F.col("text")), F.lit(END))
    said = F.struct(F.col("at"), F.concat(head, body, F.lit("\n")).alias("s"), F.length(head).alias("lo"),
                    (F.length(head) + F.length(body)).alias("hi"), own.alias("own"))
    windows = (turns.join(people, F.col("conv").eqNullSafe(F.col("p_conv")))
               .withColumn("window", F.floor(F.col("at") / window_turns))
               .groupBy("conv", "participant", "window").agg(F.sort_array(F.collect_list(said)).alias("said")))
    spans = F.expr(
        "aggregate(said, struct(0 as n, cast(array() as array<struct<start: int, stop: int>>) as spans), (acc, x) -> "
        "struct(acc.n + length(x.s) as n, cast(if(x.own, concat(acc.spans, array(struct(acc.n + x.lo as start, "
        "acc.n + x.hi as stop))), acc.spans) as array<struct<start: int, stop: int>>) as spans), acc -> acc.spans)")
    return windows.select(F.col("conv").alias(conv_col), "participant", "window", F.size("said").alias("n_turns"),
                          F.array_join(F.transform("said", lambda x: x["s"]), "").alias("text"),
                          spans.alias("loss_spans"))
