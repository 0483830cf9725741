"""Keep-first over arriving files with bounded state: a key is forgotten when the watermark has passed it.

`ingest` compares each batch with everything that ever came; here Spark's state store holds the keys of the last
`delay` of event time only. Rows of one key that are further apart may both stay, and a row that comes later than
the watermark of the batch before allows is dropped and counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankweave.operators.cleaning import FILE_RULES, CleanRules, stage
from rankweave.sources.envelopes import accepted, envelope_records, parse_payloads, stream_payloads

ISSUE_END = "issue_end"


def first_within(stream: DataFrame, keys: list[str], event_time: str | Column, delay: str) -> DataFrame:
    """One row for each key within `delay` of event time, in a column `event_time`; null keys are equal to each other.

    Which of the rows of a key that arrive in one batch stays is not said. A missing time counts as 1970.
    """
    time = F.col(event_time) if isinstance(event_time, str) else event_time
    timed = stream.withColumn("event_time", F.coalesce(time, F.timestamp_seconds(F.lit(0))))
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(keys)


def _appended(rows: DataFrame, table_uri: str, checkpoint_uri: str) -> StreamingQuery:
    """The file sink commits each batch once, so a batch that is run again adds nothing."""
    writer = rows.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint_uri).start(table_uri)


def first_within_stream(
    stream: DataFrame, keys: list[str], event_time: str | Column, delay: str, table_uri: str, checkpoint_uri: str
) -> StreamingQuery:
    """Write what `first_within` keeps to `table_uri`."""
    return _appended(first_within(stream, keys, event_time, delay), table_uri, checkpoint_uri)


def ingest_issues_within(
    spark: SparkSession,
    landing_uri: str,
    table_uri: str,
    checkpoint_uri: str,
    delay: str,
    rules: CleanRules = FILE_RULES,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Issues as in `ingest.ingest_issues`, with the end of the issue as event time; read the result with `ingest.ingested`.

    Only issues in the order of their end keep the first row of a key for certain.
    """
    documents = accepted(parse_payloads(stream_payloads(spark, landing_uri, True, files_per_batch)))
    end = F.timestamp_seconds(F.col("doc.data.config.etime").try_cast("bigint"))
    complete = stage(envelope_records(documents, **{ISSUE_END: end}), rules, [ISSUE_END]).where("_complete")
    keys = ["_key"] if rules.long_keys else rules.keys
    return first_within_stream(complete, keys, ISSUE_END, delay, table_uri, checkpoint_uri)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark, over the batches that the query still reports.

    These are the last `spark.sql.streaming.numRecentProgressUpdates`; raise it for a query of more batches.
    """
    return sum(operator["numRowsDroppedByWatermark"] for progress in query.recentProgress for operator in progress["stateOperators"])
