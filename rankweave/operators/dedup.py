"""Keep the first row of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def within(keys: list[str], order_by: list[str]) -> list[str]:
    """The order columns that can differ between rows of one key."""
    return [name for name in order_by if name not in keys] or order_by


def keep_first(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The first row per key in the given order; null keys are equal to each other.

    `dropDuplicates` does not promise which row stays. The filter on the row number lets Spark put a
    group limit before the shuffle, so each map task sends at most one row per key: a key that holds
    a large share of the table costs one row per task. For long text keys give a `digest` column.
    """
    window = Window.partitionBy(*keys).orderBy(*within(keys, order_by))
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def first_rows(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Only the `order_by` values of each key's first row. They must identify a row; null counts as a value."""
    inner = within(keys, order_by)
    firsts = df.groupBy(*keys).agg(F.min(F.struct(*inner)).alias("_place"))
    return firsts.select(*[F.col(f"_place.{name}" if name in inner else name) for name in order_by])


def mark_first(df: DataFrame, keys: list[str], order_by: list[str], out: str) -> DataFrame:
    """Every row, with a flag that tells whether it is the first of its key.

    A row number over all rows would sort a hot key in one task. The first places are found by a
    pre-aggregated minimum and joined back on `order_by`, which is unique and so cannot be skewed.
    """
    first = first_rows(df, keys, order_by).select(*[F.col(name).alias(f"_first_{name}") for name in order_by], F.lit(True).alias(out))
    same = [df[name].eqNullSafe(first[f"_first_{name}"]) for name in order_by]
    marked = df.join(first, same, "left").withColumn(out, F.coalesce(out, F.lit(False)))
    return marked.select(*df.columns, out)
