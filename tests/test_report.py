from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rankweave.operators import report


def test_metric_pages(spark):
    df = spark.createDataFrame([("u1", "abcdefghijklmno", 5), ("u1", "b", 4), ("u2", "c", 7)], "up string, title string, view long")
    got = report.metric_pages(df, ["view"], "title", "up", 2)
    assert rows(got) == [
        ("view", "rows", 1, "c", 7),
        ("view", "rows", 2, "abcdefghijkl\nmno", 5),
        ("view", "totals", 1, "u1", 9),
        ("view", "totals", 2, "u2", 7),
    ]


def test_count_page(spark):
    df = spark.createDataFrame([("longname",), ("longname",), ("longname",), ("b",)], "up string")
    assert rows(report.count_page(df, "up")) == [("b", "b", 1, 25.0), ("longname", "longna\nme", 3, 75.0)]


def test_word_weights(spark):
    df = spark.createDataFrame([("aa bb aa the", "cc the")], "title string, desc string")
    stop = spark.createDataFrame([("the",)], "word string")
    got = report.word_weights(df, ["title", "desc"], stop, 1)
    assert rows(got) == [("desc", "cc", 1), ("title", "aa", 2)]
    han = spark.createDataFrame([("中国游戏", "the 游戏")], "title string, desc string")
    dictionary = spark.createDataFrame([("中国", 5), ("游戏", 4)], "word string, freq long")
    got = report.word_weights(han, ["title", "desc"], stop, 300, dictionary)
    assert rows(got) == [("desc", "游戏", 1), ("title", "中国", 1), ("title", "游戏", 1)]


def test_correlation_triples_and_wide_matrix(spark):
    wide = spark.createDataFrame([("view", 1.0, 0.126), ("new", 0.126, 1.0)], "feature string, view double, new double")
    long = report.matrix_to_long(wide, ["view", "new"])
    got = report.correlation_triples(long, {"view": "播放量"})
    assert rows(got) == [
        (0, 0, "播放量", "播放量", 1.0),
        (0, 1, "播放量", "new", 0.13),
        (1, 0, "new", "播放量", 0.13),
        (1, 1, "new", "new", 1.0),
    ]


def test_leaderboard_series(spark):
    board = spark.createDataFrame([("GBT", 0.80614, 0.9)], "model string, accuracy double, auc double")
    assert rows(report.leaderboard_series(board)) == [("GBT", "AUC", 0.9), ("GBT", "Accuracy", 0.8061)]


@pytest.mark.parametrize("few", [True, False])
def test_lookup_names_both_ways(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(report, "fits_broadcast", lambda names: False)
    facts = spark.createDataFrame([("hot", i) for i in range(50)] + [("x", 50), (None, 51)], "code string, i int")
    names = spark.createDataFrame([("hot", "Hot"), ("hot", "Hot"), ("y", "Y")], "code string, label string")
    got = rows(report.lookup_names(facts, names, "code", "label"))
    assert len(got) == 52
    labels = {(r[0], r[2]) for r in got}
    assert labels == {("hot", "Hot"), ("x", "x"), (None, None)}


def test_equal_rows_of_a_hot_code_use_more_than_one_task(spark):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        facts = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("code"))
        names = spark.range(5000).select(F.col("id").alias("code"), F.concat(F.lit("n"), "id").alias("label"))
        got = report.lookup_names(facts, names, "code", "label", broadcast=False)
        hot = got.withColumn("part", F.spark_partition_id()).where("code = 7").agg(F.count("*"), F.countDistinct("part")).first()
        assert hot[0] == facts.where("code = 7").count() and hot[1] > 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
