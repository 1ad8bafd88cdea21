"""Order-validated positional merge: the k-th row of one side meets the k-th of the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def positional_merge(left: DataFrame, right: DataFrame, keys: list[str], order: str, name: str | None = None) -> DataFrame:
    """Full outer join on position within keys, with k and state: ok, right_short, right_long or, given a name column, mismatch."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    l = left.withColumn("k", number)  # noqa: E741
    l = l.select(*keys, "k", *[F.col(c).alias(f"left_{c}") for c in left.columns if c not in keys])  # noqa: E741
    r = right.withColumn("k", number).select(*keys, "k", *[F.col(c).alias(f"right_{c}") for c in right.columns if c not in keys])
    both = l.join(r, [*keys, "k"], "full_outer")
    state = F.when(F.col(f"right_{order}").isNull(), "right_short").when(F.col(f"left_{order}").isNull(), "right_long")
    if name:
        state = state.when(F.col(f"left_{name}") != F.col(f"right_{name}"), "mismatch")
    return both.withColumn("state", state.otherwise("ok"))


def committable(merged: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of which every position is ok; the others must be left untouched as a whole."""
    return merged.groupBy(*keys).agg(F.bool_and(F.col("state") == "ok").alias("commit"))
