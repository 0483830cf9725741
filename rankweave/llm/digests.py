"""Exact duplicates: sorted runs of digests merged in rounds of a tree.

Every input partition makes one sorted run. In each round the runs whose numbers agree above the next digit meet,
are merged in digest order, and equal entries become one with the extreme identifiers and the number of rows.
Each run is cut into ranges of digests first, so no task ever holds more than one range of a few runs, and a text
that a third of all rows share enters a task as at most one entry per run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.common import kept

# Runs that meet in one merge, a power of two: so many binomial rounds are done in one exchange.
FAN_IN = 8
# Digest entries a range should hold in the last round.
RANGE_ROWS = 1_000_000
RUN = "range int, run int, digest string, n_bytes int, seal bigint, low_id bigint, high_id bigint, rows bigint"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of a sorted stream that agree in digest, length and seal become one; the last waits for the next batch."""
    waiting = None
    keys = ["range", "run", "digest", "n_bytes", "seal"]
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if waiting is not None:
            rows = pa.concat_tables([waiting, rows])
        if not rows.num_rows:
            continue
        merged = rows.group_by(keys, use_threads=False).aggregate([("low_id", "min"), ("high_id", "max"), ("rows", "sum")])
        merged = merged.rename_columns([*keys, "low_id", "high_id", "rows"]).select(rows.column_names).cast(rows.schema)
        yield from merged.slice(0, merged.num_rows - 1).to_batches()
        waiting = merged.slice(merged.num_rows - 1)
    if waiting is not None:
        yield from waiting.to_batches()


def digested(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, digest (SHA-256 of the text in UTF-8, lowercase hex), n_bytes and seal, a second 64-bit hash."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.sha2(text, 256).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("seal"),
    )


def merge_runs(digests: DataFrame, runs: int, rows: int) -> DataFrame:
    """One entry for each different text: digest, n_bytes, seal, low_id, high_id, rows. `digests` has a column `run`."""
    ranges = max(1, math.ceil(rows / RANGE_ROWS))
    ranges = 1 << (ranges - 1).bit_length()
    # the first hexadecimal digits of a digest are a range of the sorted run
    part = (F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint") * ranges / (1 << 32)).cast("int")
    level = digests.select(
        part.alias("range"), "run", "digest", "n_bytes", "seal",
        F.col("doc_id").alias("low_id"), F.col("doc_id").alias("high_id"), F.lit(1).cast("bigint").alias("rows"),
    )
    order = ["range", "run", "digest", "n_bytes", "seal"]
    level = level.sortWithinPartitions(*order).mapInArrow(_merged, RUN)
    left = runs + 1
    while left > 1:  # once at least: a run that was read in several pieces meets here
        left = math.ceil(left / FAN_IN)
        level = level.withColumn("run", F.floor(F.col("run") / FAN_IN).cast("int"))
        level = level.repartition(max(1, ranges * left), "range", "run").sortWithinPartitions(*order).mapInArrow(_merged, RUN)
    return level.select("digest", "n_bytes", "seal", "low_id", "high_id", "rows")


def exact_duplicates(docs: DataFrame, keep: str = "high", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, n_bytes.

    Texts are equal when identical; null counts as empty. Of equal texts the one with the largest (`keep="high"`) or
    smallest (`"low"`) identifier stays. Digests are verified by length and a second hash at every level. A null
    identifier is smaller than all others and never stays beside one; a group of nulls only has a null keep_id and
    stays. Rows that repeat identifier and text share their fate and each count in group_size. Other columns of
    `docs` are not read.
    """
    digests = kept(digested(docs, id_column, text_column).withColumn("run", F.spark_partition_id()), "digests")
    size = digests.agg(F.max("run"), F.count("*")).first()
    winners = merge_runs(digests, (size[0] or 0) + 1, size[1])
    winners = winners.select("digest", "n_bytes", "seal", F.col("high_id" if keep == "high" else "low_id").alias("keep_id"), F.col("rows").alias("group_size"))
    return digests.join(winners, ["digest", "n_bytes", "seal"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"), F.col("n_bytes").cast("bigint").alias("n_bytes"),
    )
