from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from rankweave.operators import statistics

FEATURES = ["a", "b", "c"]


def table(spark, n=3000, seed=6):
    """Ties, a value on a third of the rows, negative and fractional values, and whole duplicate rows."""
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        a = 0.0 if rng.random() < 0.35 else rng.gauss(0, 100)
        b = round(a / 10) + rng.randint(0, 3)
        c = -a * rng.random()
        data.append((a, float(b), c) if rng.random() > 0.2 else (0.0, 1.0, 0.0))
    return spark.createDataFrame(data, "a double, b double, c double")


def by_library(df):
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="v").transform(df)
    return Correlation.corr(vectors, "v", "spearman").head()[0].toArray()


def matrix(long):
    return {(r["i"], r["j"]): r["value"] for r in long.collect()}


@pytest.fixture(params=["small", "ranges", "ranges_and_join"])
def path(request, monkeypatch):
    """The same data over each physical path: small limits force ranges, salted joins and hot values."""
    if request.param != "small":
        monkeypatch.setattr(statistics, "VALUES_PER_RANGE", 50)
    if request.param == "ranges_and_join":
        monkeypatch.setattr(statistics, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(statistics, "HOT_SHARE", 20)
    return request.param


def test_spearman_equals_the_library(spark, path):
    df = table(spark)
    want = by_library(df)
    got = matrix(statistics.spearman(df.repartition(5), FEATURES))
    assert len(got) == 9
    for (i, j), value in got.items():
        assert value == pytest.approx(want[i][j], abs=1e-9)
        assert value == got[(j, i)]
        assert i != j or value == 1.0


def test_spearman_leaves_out_incomplete_rows_and_takes_integers(spark):
    df = table(spark, 500)
    gaps = df.withColumn("a", F.when(F.col("b") > 5, F.col("a")))
    want = by_library(gaps.na.drop())
    got = matrix(statistics.spearman(gaps, FEATURES))
    assert got[(0, 2)] == pytest.approx(want[0][2], abs=1e-9)
    whole = df.select(F.col("b").cast("long").alias("a"), F.col("b").cast("int").alias("b"))
    assert matrix(statistics.spearman(whole, ["a", "b"]))[(0, 1)] == pytest.approx(1.0)


def test_constant_column_and_empty_table(spark):
    df = spark.range(10).select(F.lit(1.0).alias("a"), F.col("id").alias("b"))
    assert matrix(statistics.spearman(df, ["a", "b"]))[(0, 1)] is None
    assert matrix(statistics.spearman(df.limit(0), ["a", "b"]))[(0, 1)] is None


def test_matrix_form(spark):
    long = statistics.spearman(table(spark, 300), FEATURES)
    wide = statistics.correlation_matrix(long, FEATURES)
    assert wide.columns == ["feature", *FEATURES]
    cells = matrix(long)
    got = [tuple(r) for r in wide.collect()]
    assert got == [(f, *[cells[(i, j)] for j in range(3)]) for i, f in enumerate(FEATURES)]


def test_running_before_equals_brute_force(spark, path):
    df = table(spark, 2000).groupBy("a").agg(F.count(F.lit(1)).alias("w"))
    limits = statistics._range_limits(df, {"a": df.count()})["a"]
    assert bool(limits) == (path != "small")
    total, want = 0, {}
    for value, w in sorted((r["a"], r["w"]) for r in df.collect()):
        want[value] = total
        total += w
    got = {r["a"]: r["before_w"] for r in statistics.running_before(df, "a", ["w"], limits).collect()}
    assert got == want


def scored(spark, n=2000):
    rng = random.Random(7)
    data = []
    for _ in range(n):
        label = int(rng.random() < 0.3)
        data.append((label, 0.5 if rng.random() < 0.33 else round(rng.random() + 0.3 * label, 3)))
    return spark.createDataFrame(data, "label int, score double")


def test_auc_equals_the_library_with_tied_scores(spark, path):
    df = scored(spark)
    raw = df.withColumn("rawPrediction", array_to_vector(F.array(-F.col("score"), F.col("score"))))
    want = BinaryClassificationEvaluator(numBins=0).evaluate(raw)
    row = statistics.area_under_roc(df, "label", "score").first()
    assert row["auc"] == pytest.approx(want, abs=1e-12)
    assert row["positives"] == df.where("label = 1").count()


def test_auc_limits(spark):
    def auc(data):
        return statistics.area_under_roc(spark.createDataFrame(data, "label int, score double"), "label", "score").first()["auc"]

    assert auc([(0, 1.0), (1, 2.0)]) == 1.0
    assert auc([(1, 1.0), (0, 2.0)]) == 0.0
    assert auc([(1, 1.0), (0, 1.0)]) == 0.5
    assert auc([(1, 1.0)]) is None


def test_auc_counts_the_rows_it_leaves_out(spark):
    data = [(0.0, 1.0), (1.0, 2.0), (None, 1.0), (1.0, None), (0.0, float("nan")), (2.0, 1.0), (0.5, 1.0)]
    df = spark.createDataFrame(data, "label double, score double")
    row = statistics.area_under_roc(df, "label", "score").first()
    assert (row["positives"], row["negatives"], row["auc"], row["skipped"]) == (1, 1, 1.0, 5)
    assert statistics.area_under_roc(df.limit(0), "label", "score").first()["skipped"] == 0


def test_ranges_follow_the_distinct_values(spark, monkeypatch):
    monkeypatch.setattr(statistics, "VALUES_PER_RANGE", 1)
    df = spark.range(3000).select(F.col("id").cast("double").alias("value"))
    limits = statistics._range_limits(df, {"value": 3000})["value"]
    assert len(limits) > 1500


def test_the_driver_holds_no_more_limits_for_more_values(spark, monkeypatch):
    monkeypatch.setattr(statistics, "VALUES_PER_RANGE", 1)
    monkeypatch.setattr(statistics, "MOST_RANGES", 40)
    sizes = {}
    for n in (500, 20_000):
        # half of the rows have one value, which must not take the ranges of the others
        df = spark.range(2 * n).select(F.when(F.col("id") < n, F.col("id")).otherwise(3).cast("double").alias("value"))
        limits = statistics._range_limits(df, {"value": n})["value"]
        parts = [int(n * (b - a) / n) for a, b in zip([0, *limits], [*limits, n])]
        assert max(parts) < 2.5 * n / len(parts)
        sizes[n] = len(limits)
    assert sizes[500] == sizes[20_000] == 39


def test_infinite_values_keep_their_place(spark, monkeypatch):
    monkeypatch.setattr(statistics, "VALUES_PER_RANGE", 10)
    inside = [float(x) for x in range(60)]
    df = spark.createDataFrame([(x, 1) for x in [float("-inf"), *inside, float("inf")]], "v double, w long")
    limits = statistics._range_limits(df, {"v": 62})["v"]
    got = [tuple(r) for r in statistics.running_before(df, "v", ["w"], limits).orderBy("v").select("v", "before_w").collect()]
    assert limits and got == [(x, i) for i, x in enumerate([float("-inf"), *inside, float("inf")])]


def test_accuracy(spark):
    df = scored(spark, 500).withColumn("prediction", (F.col("score") > 0.6).cast("double"))
    row = statistics.accuracy(df, F.col("label"), F.col("prediction")).first()
    want = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert row["accuracy"] == pytest.approx(want)
    assert row["tp"] + row["fp"] + row["tn"] + row["fn"] == 500


def test_accuracy_is_over_the_counted_rows(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (None, 1), (1, None), (2, 2)], "t int, p int")
    assert tuple(statistics.accuracy(df, F.col("t"), F.col("p")).first()) == (1, 0, 1, 0, 1.0)
