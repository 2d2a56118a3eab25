"""Chat history windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.sources.registry import top_per


def recent(df: DataFrame, n: int) -> DataFrame:
    """The last ``n`` messages of each conversation; trimmed per partition before the shuffle."""
    return top_per(df, ["conv_id"], [F.desc("turn")], n, "_back")


def chat_window(df: DataFrame, n: int = 5) -> DataFrame:
    """Recent messages per conversation as one prefixed text."""
    who = F.when(F.col("role") == "user", "User").otherwise("Assistant")
    line = F.concat(who, F.lit(": "), F.col("text"))
    lines = F.array_sort(F.collect_list(F.struct("turn", line.alias("line"))))
    return recent(df, n).groupBy("conv_id").agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("window")
    )


def chat_turns(df: DataFrame, window: int = 5) -> DataFrame:
    """Recent messages paired into numbered user/assistant turns, one text per conversation."""
    messages = F.array_sort(F.collect_list(F.struct("turn", "text")))
    grouped = recent(df, window * 2).groupBy("conv_id").agg(messages.alias("m"))
    pairs = F.floor(F.size("m") / 2).cast("int")
    turn = F.transform(
        F.when(pairs > 0, F.sequence(F.lit(1), pairs)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(
            F.lit("[Turn "), i.cast("string"), F.lit("] User: "),
            F.element_at("m", i * 2 - 1)["text"],
            F.lit("\nAssistant: "),
            F.element_at("m", i * 2)["text"],
        ),
    )
    return grouped.select("conv_id", F.array_join(turn, "\n").alias("turns"))
