"""Label, split and compare four classifiers."""

from __future__ import annotations

from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.schemas import BEST_RANK, LEADERBOARD, METRICS

# The label limit, training share and iterations of the weekly model run.
TOP_RANK = 10
TRAIN_SHARE = 0.8
ITERATIONS = 15


def with_label(df: DataFrame, column: str = BEST_RANK, at_most: float = TOP_RANK, out: str = "label") -> DataFrame:
    """0/1 label: 1 where the column is at most the limit."""
    return df.withColumn(out, (F.col(column) <= at_most).cast("int"))


def with_split(df: DataFrame, keys: list[str], share: float = TRAIN_SHARE, out: str = "is_train") -> DataFrame:
    """Training flag from a hash of the row's key.

    A seeded random split depends on the partitioning of its input. This one gives the same rows for
    any partitioning, after any retry, without a shuffle.
    """
    limit = F.lit(f"{min(int(share * 2**32), 2**32 - 1):08x}")
    key = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return df.withColumn(out, F.substring(F.md5(key), 1, 8) < limit)


def assemble(df: DataFrame, features: list[str], keep: list[str] | None = None) -> DataFrame:
    """Feature columns as one vector. A null feature is an error: clean first."""
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    return assembler.transform(df).select("features", *(keep or ["label"]))


def prepare(
    df: DataFrame,
    keys: list[str],
    features: list[str] = METRICS,
    label_column: str = BEST_RANK,
    at_most: float = TOP_RANK,
) -> DataFrame:
    """`(features, label, is_train)` of each row."""
    labelled = with_split(with_label(df, label_column, at_most), keys)
    return assemble(labelled, features, ["label", "is_train"])


def split_counts(prepared: DataFrame) -> DataFrame:
    """`(part, rows)`: training and test rows; a part without rows is there with 0."""
    counts = prepared.agg(F.count_if("is_train").alias("train"), F.count_if(~F.col("is_train")).alias("test"))
    parts = [F.struct(F.lit(name).alias("part"), F.col(name).alias("rows")) for name in ("train", "test")]
    return counts.select(F.inline(F.array(*parts)))


def classifiers(seed: int = 42) -> dict:
    """The compared models by name, with library defaults other than those given."""
    columns = {"labelCol": "label", "featuresCol": "features"}
    return {
        "LogisticRegression": LogisticRegression(maxIter=ITERATIONS, **columns),
        "DecisionTree": DecisionTreeClassifier(seed=seed, **columns),
        "RandomForest": RandomForestClassifier(seed=seed, **columns),
        "GBT": GBTClassifier(seed=seed, **columns),
    }


def _without_summary(model):
    """The model without its training summary, which holds the session.

    A model travels to the tasks that apply it, and a session in which rows were ever observed cannot.
    """
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def leaderboard(prepared: DataFrame, models: dict | None = None, digits: int = 4) -> DataFrame:
    """`(model, accuracy, auc)` on the test rows, one row per model.

    Fitting is iterative, so the prepared rows are kept in memory with spill to disk, read from their
    source once for both parts and all models; lost blocks are computed again. Only the two measures
    per model come to the driver.
    """
    accuracy = MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="prediction", metricName="accuracy"
    )
    auc = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC"
    )
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    train, test = prepared.where("is_train"), prepared.where("not is_train")
    rows = []
    try:
        for name, classifier in (models or classifiers()).items():
            model = _without_summary(classifier.fit(train))
            scored = model.transform(test).select("label", "prediction", "rawPrediction")
            scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                rows.append((name, round(accuracy.evaluate(scored), digits), round(auc.evaluate(scored), digits)))
            finally:
                scored.unpersist()
    finally:
        prepared.unpersist()
    return prepared.sparkSession.createDataFrame(rows, LEADERBOARD)
