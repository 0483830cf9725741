"""Rankings that follow a stream: each batch adds what its new rows contribute, and reading merges the contributions.

Keep-first never takes a row back, so a contribution is final. The contributions are runs that are merged by size
(`runs`): what is read for a ranking grows with the number of its groups, not with the number of rows or batches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.operators import ranking, words
from rankweave.sinks import write_table
from rankweave.streaming.runs import Runs

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Ranking:
    """What rows contribute, how contributions of several batches are merged, and the result of merged ones."""

    name: str
    partial: Step
    merge: Step
    result: Step


def group_counts(name: str, key: str, k: int = 10, out: str = "count") -> Ranking:
    """As `ranking.top_groups`."""
    return Ranking(
        name,
        lambda rows: rows.groupBy(key).agg(F.count(key).alias(out)),
        lambda parts: parts.groupBy(key).agg(F.sum(out).alias(out)),
        lambda merged: ranking.largest(merged, [key], out, k),
    )


def group_sums(name: str, key: str, metrics: list[str], k: int = 10) -> Ranking:
    """As `ranking.top_group_sums_by_metric`, for whole numbers, whose sums do not depend on the batches."""
    summed = lambda rows: rows.groupBy(key).agg(*[F.sum(metric).alias(metric) for metric in metrics])
    return Ranking(
        name,
        summed,
        summed,
        lambda merged: ranking.best_by_metric(ranking.by_metric(merged, [key], metrics, "total"), [key], "total", k),
    )


def best_rows(name: str, columns: list[str], metrics: list[str], k: int = 10) -> Ranking:
    """As `ranking.top_rows_by_metric`: a row that is not among the k best of its batch is not among those of all."""
    best = lambda rows: ranking.best_by_metric(rows.drop("rank"), columns, "value", k)
    return Ranking(name, lambda rows: ranking.top_rows_by_metric(rows, columns, metrics, k), best, best)


def word_totals(name: str, fields: list[str], k: int = 300, stop_words: DataFrame | None = None) -> Ranking:
    """As `words.field_word_counts` and the k most frequent of each field; stop words may change between two readings."""

    def result(merged: DataFrame) -> DataFrame:
        return words.top_words(merged if stop_words is None else words.drop_stop_words(merged, stop_words), k, "field")

    return Ranking(
        name,
        lambda rows: words.field_word_counts(rows, fields),
        lambda parts: parts.groupBy("field", "word").agg(F.sum("count").alias("count")),
        result,
    )


def _uri(rankings_uri: str, own: Ranking) -> str:
    return f"{rankings_uri.rstrip('/')}/{own.name}"


def add_batch(rows: DataFrame, batch_id: int, rankings: list[Ranking], rankings_uri: str) -> None:
    """Add the contribution of a batch's new rows; a batch that is run again replaces it."""
    for own in rankings:
        partial = own.partial(rows)
        runs = Runs(rows.sparkSession, _uri(rankings_uri, own), partial.schema, own.merge)
        name = runs.own(batch_id)
        write_table(partial, runs.folder(name))
        runs.add(batch_id, name)


def current(spark: SparkSession, rankings_uri: str, own: Ranking) -> DataFrame | None:
    """The ranking over all batches so far; None before the first one."""
    runs = Runs(spark, _uri(rankings_uri, own), None, own.merge)
    parts = runs.read(runs.before())
    return None if parts is None else own.result(own.merge(parts))
