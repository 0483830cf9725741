"""Rank correlation and classification measures that hold up on large tables with hot values."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.functions.numeric import all_of
from rankweave.storage import BROADCAST_ROWS

# Distinct values one window task should sort.
VALUES_PER_RANGE = 1_000_000
# Ranges at most. With more distinct values than they are made for ranges are larger and sort on disk.
MOST_RANGES = 4096
# Values picked to place the range limits, and the size of the sketch that the limits are read from.
RANGE_PICKS = 16 * MOST_RANGES
SKETCH_SIZE = 4096
# A value on more than 1/HOT_SHARE of the rows is hot; there are at most HOT_SHARE such values.
HOT_SHARE = 1000
# Keys the rows of one hot value are spread over.
SALTS = 256


def _profile(df: DataFrame, columns: list[str]) -> tuple[int, dict[str, int]]:
    """Row count and estimated distinct values per column, in one pass to one row."""
    estimates = [F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *estimates).first()
    return row["n"], {c: row[f"d{i}"] for i, c in enumerate(columns)}


def _stacked(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """`(*keep, place, value)`: several double columns as rows, by place in the list, from one pass."""
    pairs = [F.struct(F.lit(i).alias("place"), F.col(c).alias("value")) for i, c in enumerate(columns)]
    return df.select(*keep, F.inline(F.array(*pairs)))


def _range_limits(df: DataFrame, distinct: dict[str, int]) -> dict[str, list[float]]:
    """Per column, values that split its distinct values into ranges of about equal size.

    Limits only spread the work: results are exact for any limits. One value is picked from each hash
    group, the one with the smallest hash, which is an even choice among the distinct values whatever
    their frequency; quantile sketches take in the picks. The driver gets one row, with
    MOST_RANGES limits a column at most, so that all steps and retries use the same.
    """
    ranges = {c: min(MOST_RANGES, -(-d // VALUES_PER_RANGE)) for c, d in distinct.items()}
    split = [c for c, count in ranges.items() if count > 1]
    limits = {c: [] for c in distinct}
    if not split:
        return limits
    code = F.xxhash64("value")
    groups = _stacked(df, split).groupBy("place", F.pmod(code, F.lit(RANGE_PICKS)).alias("group"))
    picks = groups.agg(F.min_by("value", code).alias("value"))
    sketches = {c: F.kll_sketch_agg_double(F.when(F.col("place") == i, F.col("value")), F.lit(SKETCH_SIZE)) for i, c in enumerate(split)}
    shares = {c: F.lit([i / ranges[c] for i in range(1, ranges[c])]) for c in split}
    quantiles = picks.agg(*[F.kll_sketch_get_quantile_double(sketches[c], shares[c]) for c in split]).first()
    for c, values in zip(split, quantiles):
        limits[c] = sorted({value for value in values or () if abs(value) < float("inf")})
    return limits


def running_before(
    values: DataFrame, value: str, amounts: list[str], limits: list[float], prefix: str = "before_"
) -> DataFrame:
    """Sums of `amounts` over all smaller values, for rows with one distinct double value each.

    A plain running window would sort every value in one task. The values are put into ranges; the
    sum is the total of the lower ranges plus the running sum inside the range.
    """
    if limits:
        splits = [float("-inf"), *limits, float("inf")]
        ranged = Bucketizer(splits=splits, inputCol=value, outputCol="_range").transform(values)
    else:
        ranged = values.withColumn("_range", F.lit(0.0))
    inside = Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    sums = {prefix + a: F.coalesce(F.sum(a).over(inside), F.lit(0)) for a in amounts}
    if not limits:
        return ranged.withColumns(sums).drop("_range")
    # One row for each of MOST_RANGES ranges at most: small enough for one window task and for a broadcast.
    lower = Window.partitionBy(F.lit(1)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(*[F.sum(a).alias(a) for a in amounts])
        .select("_range", *[F.coalesce(F.sum(a).over(lower), F.lit(0)).alias(f"_lower_{a}") for a in amounts])
    )
    joined = ranged.withColumns(sums).join(F.broadcast(offsets), "_range")
    whole = {prefix + a: F.col(prefix + a) + F.col(f"_lower_{a}") for a in amounts}
    return joined.withColumns(whole).drop("_range", *[f"_lower_{a}" for a in amounts])


def _attach_rank(
    rows: DataFrame, counts: DataFrame, ranks: DataFrame, column: str, out: str, distinct: int, n: int
) -> DataFrame:
    """Add the centred rank of `column`.

    `counts` is `(value, w)` and `ranks` is `(value, w, rank)`, both with one row per value. Few values
    are broadcast; the estimate of their number is within a few percent. Many are shuffled by value,
    with the rows of a hot value spread over SALTS keys and its rank repeated for each of them. The
    list of hot values has at most HOT_SHARE rows, so it can be broadcast.
    """
    named = ranks.select(F.col("value").alias(column), "w", F.col("rank").alias(out))
    if distinct <= BROADCAST_ROWS:
        return rows.join(F.broadcast(named.drop("w")), column)
    is_hot = F.col("w") * HOT_SHARE > n
    hot = counts.where(is_hot).select(F.col("value").alias(column), F.lit(True).alias("_hot"))
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    salted = rows.join(F.broadcast(hot), column, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = named.select(column, F.explode(salts).alias("_salt"), out)
    return salted.join(repeated, [column, "_salt"]).drop("_salt", "_hot")


def spearman(df: DataFrame, features: list[str]) -> DataFrame:
    """`(i, j, feature_i, feature_j, value)`: rank correlation of every pair, ties by middle rank.

    Rows with a null in any feature are left out. Equal rows are merged first, so a frequent
    combination is one row with a weight. Ranks are centred by their known mean (n + 1) / 2, so the
    products can be summed without cancellation.
    """
    rows = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    rows = rows.where(all_of([F.col(f).isNotNull() & ~F.isnan(f) for f in features]))
    n, distinct = _profile(rows, features)
    limits = _range_limits(rows, distinct)
    merged = rows.groupBy(*features).agg(F.count(F.lit(1)).alias("_weight"))
    ranked = merged
    for i, feature in enumerate(features):
        counts = merged.groupBy(F.col(feature).alias("value")).agg(F.sum("_weight").alias("w"))
        before = running_before(counts, "value", ["w"], limits[feature])
        centred = F.col("before_w") + (F.col("w") + 1) / 2.0 - F.lit((n + 1) / 2.0)
        ranks = before.select("value", "w", centred.cast("double").alias("rank"))
        ranked = _attach_rank(ranked, counts, ranks, feature, f"_r{i}", distinct[feature], n)
    products = [(i, i) for i in range(len(features))] + list(combinations(range(len(features)), 2))
    sums = ranked.agg(
        *[F.sum(F.col("_weight") * F.col(f"_r{i}") * F.col(f"_r{j}")).alias(f"s_{i}_{j}") for i, j in products]
    )
    cells = []
    for i, first in enumerate(features):
        for j, second in enumerate(features):
            cells.append(
                F.struct(
                    F.lit(i).cast("bigint").alias("i"),
                    F.lit(j).cast("bigint").alias("j"),
                    F.lit(first).alias("feature_i"),
                    F.lit(second).alias("feature_j"),
                    _correlation(i, j).alias("value"),
                )
            )
    return sums.select(F.inline(F.array(*cells)))


def _correlation(i: int, j: int) -> Column:
    if i == j:
        return F.lit(1.0).cast("double")
    low, high = sorted((i, j))
    spread = F.sqrt(F.col(f"s_{i}_{i}")) * F.sqrt(F.col(f"s_{j}_{j}"))
    return F.col(f"s_{low}_{high}") / F.when(spread > 0, spread)


def correlation_matrix(long: DataFrame, features: list[str]) -> DataFrame:
    """Wide form of `spearman`: a leading `feature` column and one column per feature."""
    wide = long.groupBy("i", F.col("feature_i").alias("feature")).agg(
        *[F.max(F.when(F.col("feature_j") == f, F.col("value"))).alias(f) for f in features]
    )
    return wide.orderBy("i").drop("i")


def accuracy(df: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    """Confusion counts and accuracy of two 0/1 columns, in one aggregate; accuracy is over the counted rows."""
    flags = df.select(truth.cast("int").alias("t"), predicted.cast("int").alias("p"))
    return flags.agg(
        F.count_if(F.expr("t = 1 and p = 1")).alias("tp"),
        F.count_if(F.expr("t = 0 and p = 1")).alias("fp"),
        F.count_if(F.expr("t = 0 and p = 0")).alias("tn"),
        F.count_if(F.expr("t = 1 and p = 0")).alias("fn"),
        F.avg(F.when(F.expr("t in (0, 1) and p in (0, 1)"), F.expr("if(t = p, 1.0D, 0.0D)"))).alias("accuracy"),
    )


def area_under_roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row `(positives, negatives, auc, skipped)`; tied scores count half.

    Rows with a missing score (null or NaN) or a label that is not 0 or 1 are left out and counted in
    `skipped`. Works on one row per distinct score. Counts are multiplied as decimals, so the sum is exact and
    does not depend on partition order.
    """
    scored = df.select(F.col(label).cast("double").alias("label"), F.col(score).cast("double").alias("score"))
    used = "label in (0, 1) and score is not null and not isnan(score)"
    rows, distinct = scored.agg(F.count(F.lit(1)), F.approx_count_distinct(F.when(F.expr(used), F.col("score")))).first()
    scored = scored.where(used)
    limits = _range_limits(scored, {"score": distinct})["score"]
    per_score = scored.groupBy("score").agg(
        F.count_if(F.expr("label = 1")).alias("pos"), F.count_if(F.expr("label = 0")).alias("neg")
    )
    before = running_before(per_score, "score", ["neg"], limits)
    wide = "decimal(18,0)"
    halves = F.col("pos").cast(wide) * (2 * F.col("before_neg") + F.col("neg")).cast(wide)
    sums = before.agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.sum(halves).alias("halves")
    )
    pairs = 2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    used = F.coalesce(F.col("positives") + F.col("negatives"), F.lit(0))
    return sums.select(
        "positives",
        "negatives",
        (F.col("halves").cast("double") / F.when(pairs > 0, pairs)).alias("auc"),
        (F.lit(rows).cast("bigint") - used).alias("skipped"),
    )
