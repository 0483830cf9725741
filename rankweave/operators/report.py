"""Chart data as tables: what a chart draws, without the chart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.functions.text import display_name, wrap_text
from rankweave.operators.ranking import (
    share_of_shown,
    top_group_sums_by_metric,
    top_groups,
    top_rows_by_metric,
)
from rankweave.operators.segment import dictionary_word_counts
from rankweave.operators.words import by_field, drop_stop_words, field_word_counts, top_words
from rankweave.storage import fits_broadcast

# Label widths: bars of metric pages and of count pages.
METRIC_LABEL = 12
COUNT_LABEL = 6


def metric_pages(
    df: DataFrame,
    metrics: list[str],
    row_label: str,
    group_key: str,
    k: int = 10,
    every: int = METRIC_LABEL,
    scale: int | None = None,
) -> DataFrame:
    """`(metric, series, rank, label, value)`: best rows and best group totals of each metric."""
    rows = top_rows_by_metric(df, [row_label], metrics, k).withColumnRenamed(row_label, "name")
    totals = top_group_sums_by_metric(df, group_key, metrics, k, scale).select("metric", "rank", F.col(group_key).alias("name"), F.col("total").alias("value"))
    return page_series(rows, "rows", every).unionByName(page_series(totals, "totals", every))


def page_series(ranked: DataFrame, name: str, every: int = METRIC_LABEL) -> DataFrame:
    """One series of metric pages, from `(metric, rank, name, value)`."""
    label = wrap_text(F.col("name").cast("string"), every).alias("label")
    return ranked.select("metric", F.lit(name).alias("series"), "rank", label, "value")


def count_page(df: DataFrame, key: str, k: int = 10, every: int = COUNT_LABEL) -> DataFrame:
    """`(key, label, count, percent)`: largest groups with their share of the rows shown."""
    return shown_page(top_groups(df, key, k), key, every)


def shown_page(shown: DataFrame, key: str, every: int = COUNT_LABEL) -> DataFrame:
    """The same from the groups that are shown, `(key, count)`."""
    label = wrap_text(F.col(key).cast("string"), every).alias("label")
    return share_of_shown(shown, "count").select(key, label, "count", "percent")


def word_weights(
    df: DataFrame,
    fields: list[str],
    stop_words: DataFrame,
    k: int = 300,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """`(field, word, count)`: the most frequent words of each text field.

    With a `dictionary` `(word, freq)`, runs of Han characters are cut into its words.
    """
    if dictionary is None:
        counts = field_word_counts(df, fields)
    else:
        counts = dictionary_word_counts(by_field(df, fields), "text", dictionary, ["field"])
    return top_words(drop_stop_words(counts, stop_words), k, "field")


def correlation_triples(long: DataFrame, names: dict[str, str], digits: int = 2) -> DataFrame:
    """`(i, j, label_i, label_j, value)` of a heat map, from the long correlation table."""
    return long.select(
        "i",
        "j",
        display_name(F.col("feature_i"), names).alias("label_i"),
        display_name(F.col("feature_j"), names).alias("label_j"),
        F.round("value", digits).alias("value"),
    )


def matrix_to_long(matrix: DataFrame, features: list[str]) -> DataFrame:
    """A wide matrix with a leading `feature` column as `(i, j, feature_i, feature_j, value)`."""
    place = F.create_map(*[F.lit(part) for i, f in enumerate(features) for part in (f, i)])
    cells = [
        F.struct(F.lit(j).cast("bigint").alias("j"), F.lit(f).alias("feature_j"), F.col(f"`{f}`").alias("value"))
        for j, f in enumerate(features)
    ]
    rows = matrix.select(F.col("feature").alias("feature_i"), F.inline(F.array(*cells)))
    return rows.select(place[F.col("feature_i")].cast("bigint").alias("i"), "j", "feature_i", "feature_j", "value")


def series_long(
    wide: DataFrame, key: str, measures: dict[str, str], digits: int | None = None, rows_label: str = "measure"
) -> DataFrame:
    """`(key, measure, value)`: one series per measure column, named by `measures`."""

    def value(column: str):
        number = F.col(column).cast("double")
        return number if digits is None else F.round(number, digits)

    pairs = [F.struct(F.lit(name).alias(rows_label), value(c).alias("value")) for c, name in measures.items()]
    return wide.select(key, F.inline(F.array(*pairs)))


def leaderboard_series(board: DataFrame) -> DataFrame:
    """`(model, measure, value)` of the model comparison."""
    return series_long(board, "model", {"accuracy": "Accuracy", "auc": "AUC"}, 4)


def lookup_names(df: DataFrame, names: DataFrame, code: str, label: str, broadcast: bool | None = None) -> DataFrame:
    """Left join of display names `(code, label)`; an unknown code is its own label.

    The names are broadcast when counting shows that they are few and short, or as `broadcast` says.
    Otherwise both sides are shuffled by code. A hot code has one name, so adaptive execution splits its
    rows by the tasks they come from, also where they are equal in every column, and repeats that name.
    """
    unique = names.groupBy(code).agg(F.min(label).alias(label))
    if fits_broadcast(unique) if broadcast is None else broadcast:
        joined = df.join(F.broadcast(unique), code, "left")
    else:
        joined = df.hint("merge").join(unique, code, "left")
    return joined.withColumn(label, F.coalesce(F.col(label), F.col(code).cast("string")))


def union_all(tables: list[DataFrame]) -> DataFrame:
    """One table of several with the same columns."""
    return reduce(DataFrame.unionByName, tables)
