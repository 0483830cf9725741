from __future__ import annotations

import pytest
from conftest import rows, values
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rankweave.operators import learning


def test_label_limit(spark):
    df = spark.createDataFrame([(10,), (11,), (1,), (None,)], "his_rank int").coalesce(1)
    assert values(learning.with_label(df).select("label")) == [1, 0, 1, None]


def test_split_is_the_same_for_any_partitioning(spark):
    df = spark.range(20_000).withColumn("k", F.concat(F.lit("u"), "id"))
    one = learning.with_split(df, ["k"])
    other = learning.with_split(df.repartition(7), ["k"])
    assert rows(one) == rows(other)
    share = one.where("is_train").count() / 20_000
    assert abs(share - 0.8) < 0.01
    everything = learning.with_split(df, ["k"], 1.0)
    assert everything.where("not is_train").count() <= 1


def test_assemble_refuses_nulls(spark):
    df = spark.createDataFrame([(1, 2.0, 1), (None, 2.0, 1)], "a long, b double, label int")
    got = learning.assemble(df.na.drop(), ["a", "b"]).select(vector_to_array("features"), "label")
    assert rows(got) == [([1.0, 2.0], 1)]
    with pytest.raises(Exception, match="null|Null"):
        learning.assemble(df, ["a", "b"]).collect()


def test_leaderboard_on_separable_rows(spark):
    df = spark.range(400).select(
        F.concat(F.lit("k"), "id").alias("key"),
        (F.col("id") % 20 + 1).alias("his_rank"),
        (1000 - 40 * (F.col("id") % 20) + F.col("id") % 7).cast("double").alias("view"),
        (F.col("id") % 13).cast("double").alias("like"),
    )
    prepared = learning.prepare(df, ["key"], ["view", "like"])
    assert prepared.columns == ["features", "label", "is_train"] and prepared.count() == 400
    board = learning.leaderboard(prepared)
    assert board.columns == ["model", "accuracy", "auc"]
    got = board.collect()
    assert [r["model"] for r in got] == ["LogisticRegression", "DecisionTree", "RandomForest", "GBT"]
    for row in got:
        assert 0 <= row["accuracy"] <= 1 and row["accuracy"] == round(row["accuracy"], 4)
        assert row["auc"] > 0.9
    assert not prepared.is_cached


def test_leaderboard_equals_direct_fits(spark):
    """Overlapping classes, so that the models differ; the same rows in the same partitions for both."""
    df = spark.range(900, numPartitions=3).select(
        F.concat(F.lit("k"), "id").alias("key"),
        (F.col("id") % 20 + 1).alias("his_rank"),
        ((F.col("id") * 7919) % 400 - 15 * (F.col("id") % 20)).cast("double").alias("view"),
        ((F.col("id") * 104_729) % 37).cast("double").alias("like"),
    )
    prepared = learning.prepare(df, ["key"], ["view", "like"])
    train, test = prepared.where("is_train"), prepared.where("not is_train")
    columns = {"labelCol": "label", "featuresCol": "features"}
    models = {
        "LogisticRegression": LogisticRegression(maxIter=15, **columns),
        "DecisionTree": DecisionTreeClassifier(seed=42, **columns),
        "RandomForest": RandomForestClassifier(seed=42, **columns),
        "GBT": GBTClassifier(seed=42, **columns),
    }
    want = []
    for name, model in models.items():
        scored = model.fit(train).transform(test)
        right = scored.where("label = prediction").count() / scored.count()
        want.append((name, round(right, 4), round(BinaryClassificationEvaluator(labelCol="label").evaluate(scored), 4)))
    got = [tuple(r) for r in learning.leaderboard(prepared).collect()]
    assert got == want and len({r[1:] for r in got}) > 1 and all(0.5 < r[2] < 1 for r in got)
    assert rows(learning.split_counts(prepared)) == sorted([("train", train.count()), ("test", test.count())], key=repr)


def test_leaderboard_in_a_session_that_observed_rows(spark):
    own = spark.newSession()
    own.range(10).observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    df = own.range(200).selectExpr("concat('k', id) AS key", "id % 20 + 1 AS his_rank", "cast(id % 20 AS double) AS view", "cast(id % 13 AS double) AS like")
    columns = {"labelCol": "label", "featuresCol": "features"}
    models = {"LogisticRegression": LogisticRegression(maxIter=5, **columns), "RandomForest": RandomForestClassifier(seed=42, numTrees=3, **columns)}
    board = learning.leaderboard(learning.prepare(df, ["key"], ["view", "like"]), models).collect()
    assert [r["model"] for r in board] == list(models) and all(r["auc"] > 0.9 for r in board)
