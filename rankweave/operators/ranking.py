"""Top-k tables. Every order ends in the output columns, so ties never make a result differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions.numeric import any_of, exact_sum

# Groups of rows whose maxima give the lower bound in `top_rows_by_metric`; also its collected size.
FLOOR_GROUPS = 1024


def _check(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")


def _down(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def _up(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def top_groups(df: DataFrame, key: str, k: int = 10, out: str = "count") -> DataFrame:
    """Keys with the most non-null rows. A null key is a group with count 0."""
    _check(df, key)
    return largest(df.groupBy(key).agg(F.count(key).alias(out)), [key], out, k)


def largest(df: DataFrame, columns: list[str], value: str, k: int) -> DataFrame:
    """The k rows with the largest value."""
    return df.orderBy(_down(value), *[_up(c) for c in columns]).limit(k)


def top_rows(df: DataFrame, metric: str, columns: list[str], k: int = 10) -> DataFrame:
    """Rows with the largest value of one metric."""
    _check(df, metric, *columns)
    return largest(df.select(*columns, metric), columns, metric, k)


def top_group_sums(
    df: DataFrame, key: str, metric: str, k: int = 10, out: str = "total", scale: int | None = None
) -> DataFrame:
    """Keys with the largest sum of one metric."""
    _check(df, key, metric)
    totals = df.groupBy(key).agg(exact_sum(df, metric, scale).alias(out))
    return largest(totals, [key], out, k)


def top_group_sums_by_metric(
    df: DataFrame, key: str, metrics: list[str], k: int = 10, scale: int | None = None
) -> DataFrame:
    """`(metric, rank, key, total)` for all metrics from one pass over the table."""
    _check(df, key, *metrics)
    totals = df.groupBy(key).agg(*[exact_sum(df, m, scale).alias(m) for m in metrics])
    return best_by_metric(by_metric(totals, [key], metrics, "total"), [key], "total", k)


def top_rows_by_metric(df: DataFrame, columns: list[str], metrics: list[str], k: int = 10) -> DataFrame:
    """`(metric, rank, *columns, value)` for all metrics.

    Two passes for any number of metrics. The first reads the metrics only: the k-th largest of the
    maxima of hash groups is a lower bound of the k-th largest row. The second reads the other
    columns for rows that reach the bound of some metric, which the scan can skip row groups by.
    Nothing that belongs to the result can be below its bound, whatever the ties; only what reaches
    it is sorted.
    """
    _check(df, *columns, *metrics)
    floors = _floors(df, metrics, k)
    if any(floor is None for floor in floors.values()):
        return best_by_metric(by_metric(df.select(*columns, *metrics), columns, metrics, "value"), columns, "value", k)
    reaching = df.where(any_of([F.col(m) >= F.lit(floor) for m, floor in floors.items()]))
    rows = by_metric(reaching.select(*columns, *metrics), columns, metrics, "value")
    own = [(F.col("metric") == m) & (F.col("value") >= F.lit(floor)) for m, floor in floors.items()]
    return best_by_metric(rows.where(any_of(own)), columns, "value", k)


def _floors(df: DataFrame, metrics: list[str], k: int) -> dict[str, object]:
    groups = df.groupBy(F.pmod(F.xxhash64(*metrics), F.lit(FLOOR_GROUPS))).agg(
        *[F.max(m).alias(m) for m in metrics]
    )
    kth = groups.agg(
        *[F.get(F.sort_array(F.collect_list(m), asc=False), k - 1).alias(m) for m in metrics]
    )
    return kth.first().asDict()


def by_metric(df: DataFrame, columns: list[str], metrics: list[str], out: str) -> DataFrame:
    """One row per metric and input row. Unlike `unpivot`, takes metrics of different number types."""
    types = {df.schema[m].dataType for m in metrics}
    if len(types) == 1:
        common = types.pop()
    else:
        common = "bigint" if all(isinstance(t, T.IntegralType) for t in types) else "double"
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast(common).alias(out)) for m in metrics]
    return df.select(*columns, F.inline(F.array(*pairs)))


def best_by_metric(rows: DataFrame, columns: list[str], value: str, k: int) -> DataFrame:
    """The k rows of each metric with the largest value, with their rank."""
    window = Window.partitionBy("metric").orderBy(_down(value), *[_up(c) for c in columns])
    ranked = rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return ranked.select("metric", F.col("rank").cast("bigint").alias("rank"), *columns, value)


def share_of_shown(shown: DataFrame, value: str, out: str = "percent", digits: int = 2) -> DataFrame:
    """Share of each row in the sum over the rows of a top-k table, in percent.

    The base is the rows shown, not the table behind them. For results with a row limit: the window
    has no partition key.
    """
    total = F.sum(F.col(value).cast("double")).over(Window.partitionBy(F.lit(1)))
    return shown.withColumn(out, F.round(F.lit(100.0).cast("double") * F.col(value) / total, digits))
