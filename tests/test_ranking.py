from __future__ import annotations

import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rankweave.operators import ranking


def table(spark, n=2000, seed=3):
    rng = random.Random(seed)
    data = [
        ("hot" if rng.random() < 0.33 else f"u{rng.randint(0, 40)}", f"t{rng.randint(0, 300)}", rng.randint(0, 50), rng.randint(0, 10**6))
        for _ in range(n)
    ]
    return spark.createDataFrame(data, "up string, title string, a long, b long")


def brute_rows(data, metric, k=10):
    return sorted(data, key=lambda r: (-r[metric], r["title"]))[:k]


@pytest.mark.parametrize("parts", [1, 7])
def test_top_groups_with_ties(spark, parts):
    df = spark.createDataFrame([(x,) for x in "bbaaccd"], "k string").repartition(parts)
    assert [tuple(r) for r in ranking.top_groups(df, "k", 2).collect()] == [("a", 2), ("b", 2)]


def test_a_null_group_counts_zero(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    assert [tuple(r) for r in ranking.top_groups(df, "k").collect()] == [("a", 1), (None, 0)]


def test_top_rows_is_a_top_k_not_a_sort(spark):
    top = ranking.top_rows(table(spark), "b", ["title"])
    assert "TakeOrderedAndProject" in plan(top)
    assert "TakeOrderedAndProject" in plan(ranking.top_groups(table(spark), "up"))


def test_rows_by_metric_equal_one_query_per_metric(spark):
    df = table(spark)
    got = ranking.top_rows_by_metric(df.repartition(5), ["title"], ["a", "b"])
    for metric in ("a", "b"):
        one = [(metric, i, r["title"], r[metric]) for i, r in enumerate(ranking.top_rows(df, metric, ["title"]).collect(), 1)]
        assert [tuple(r) for r in got.where(F.col("metric") == metric).orderBy("rank").collect()] == one
        brute = brute_rows(df.collect(), metric)
        assert [(r[2], r[3]) for r in one] == [(r["title"], r[metric]) for r in brute]


def test_rows_by_metric_when_all_values_tie(spark):
    df = spark.range(5000).select(F.format_string("t%05d", "id").alias("title"), F.lit(7).alias("a"), F.lit(1.5).alias("b"))
    got = ranking.top_rows_by_metric(df, ["title"], ["a", "b"], 3)
    assert rows(got) == sorted(
        [(m, i + 1, f"t{i:05d}", v) for m, v in (("a", 7.0), ("b", 1.5)) for i in range(3)], key=repr
    )


def test_rows_by_metric_with_nulls_and_few_rows(spark):
    df = spark.createDataFrame([("x", 1, None), ("y", None, None)], "title string, a long, b long")
    got = ranking.top_rows_by_metric(df, ["title"], ["a", "b"], 3)
    assert rows(got.where("metric = 'a'")) == [("a", 1, "x", 1), ("a", 2, "y", None)]
    assert got.where("metric = 'b'").count() == 2


def test_group_sums_by_metric_equal_one_query_per_metric(spark):
    df = table(spark)
    got = ranking.top_group_sums_by_metric(df, "up", ["a", "b"])
    for metric in ("a", "b"):
        one = ranking.top_group_sums(df, "up", metric).collect()
        best = got.where(F.col("metric") == metric).orderBy("rank").select("key" if "key" in got.columns else "up", "total")
        assert [tuple(r) for r in best.collect()] == [tuple(r) for r in one]
        values = [r["total"] for r in one]
        assert values == sorted(values, reverse=True) and len(values) == 10
    assert "WindowGroupLimit" in plan(got)


def test_decimal_sums_do_not_depend_on_order(spark):
    df = spark.range(10_000).select(F.lit("k").alias("up"), F.lit(0.1).alias("a"))
    for parts in (1, 3, 8):
        assert ranking.top_group_sums(df.repartition(parts), "up", "a", scale=2).first()["total"] == 1000.0


def test_share_is_of_the_rows_shown(spark):
    df = spark.createDataFrame([(f"g{i:02d}",) for i in range(12) for _ in range(i + 1)], "g string")
    shown = ranking.share_of_shown(ranking.top_groups(df, "g"), "count").collect()
    assert len(shown) == 10
    total = sum(r["count"] for r in shown)
    assert [r["percent"] for r in shown] == [round(100 * r["count"] / total, 2) for r in shown]
    assert abs(sum(r["percent"] for r in shown) - 100) < 0.1


def test_unknown_columns_are_refused(spark):
    df = table(spark, 5)
    for call in (
        lambda: ranking.top_groups(df, "no"),
        lambda: ranking.top_rows(df, "a; drop", ["title"]),
        lambda: ranking.top_rows_by_metric(df, ["no"], ["a"]),
        lambda: ranking.top_group_sums_by_metric(df, "up", ["no"]),
    ):
        with pytest.raises(ValueError, match="no such column"):
            call()
