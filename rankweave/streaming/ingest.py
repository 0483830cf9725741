"""File arrival: each micro-batch adds the rows whose key was not seen before.

"First" is the first arrival across batches, and the given order inside a batch; a batch job over all
files at once uses the given order throughout.

The keys seen so far are the table already written, not operator state. So state cannot outgrow
executor memory, and a hot key is reduced before the shuffle, as in the batch job. Each batch writes
its own folder by overwriting it: a batch that is run again after a failure gives the same table. The keys of
earlier batches are read from runs that are merged by size (`runs`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankweave.functions.text import clean_text
from rankweave.operators.cleaning import DUPLICATE, FILE_RULES, CleanRules, audit_rows, finish, first_complete, rejected, stage
from rankweave.operators.dedup import keep_first
from rankweave.sinks import write_table
from rankweave.sources.envelopes import EMPTY, accepted, empty_files, envelope_records, parse_payloads, refused, stream_payloads
from rankweave.storage import fits_broadcast
from rankweave.streaming.rankings import Ranking, add_batch
from rankweave.streaming.runs import BATCH, Runs


def _batch_folder(uri: str, batch_id: int) -> str:
    return f"{uri.rstrip('/')}/{BATCH}={batch_id}"


def _unseen(firsts: DataFrame, keys: list[str], earlier: DataFrame) -> DataFrame:
    """The rows of `firsts` whose key is not in `earlier`; `firsts` is held, as it is read several times.

    The keys of earlier batches are cut to those of this one before anything is shuffled where the batch's keys,
    counted, can be broadcast. Both sides hold each key once, so the join has no skew.
    """
    earlier = earlier.select(*[F.col(key).alias(f"_earlier_{key}") for key in keys])
    arrived = firsts.select(*[F.col(key).alias(f"_arrived_{key}") for key in keys])
    if fits_broadcast(arrived):
        met = [F.col(f"_earlier_{key}").eqNullSafe(F.col(f"_arrived_{key}")) for key in keys]
        earlier = earlier.join(F.broadcast(arrived), met, "left_semi")
    same = [firsts[key].eqNullSafe(earlier[f"_earlier_{key}"]) for key in keys]
    return firsts.join(earlier, same, "left_anti")


def _write_unseen(firsts: DataFrame, keys: list[str], uri: str, batch_id: int, counts: dict[str, Column] | None = None) -> dict[str, int]:
    """Add the batch's folder to the table; `counts` are taken from the rows written, in the tasks that write them."""
    runs = Runs(firsts.sparkSession, uri, firsts.select(*keys).schema)
    earlier = runs.read(runs.before(batch_id))
    held = firsts if earlier is None else firsts.persist()
    seen = Observation()
    try:
        unseen = held if earlier is None else _unseen(held, keys, earlier)
        if counts:
            unseen = unseen.observe(seen, *[value.alias(name) for name, value in counts.items()])
        write_table(unseen, _batch_folder(uri, batch_id))
    finally:
        held.unpersist()
    runs.add(batch_id, f"{BATCH}={batch_id}")
    found = seen.get if counts else {}
    return {name: found.get(name) or 0 for name in counts or {}}


def _rejected(records: DataFrame, firsts: DataFrame, written: DataFrame, rules: CleanRules) -> DataFrame:
    """Rows of a batch that do not come into the clean table, with the rule that removed them.

    As in the batch job, and a batch's first row of a key that an earlier batch has is a duplicate too.
    """

    def places(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(name).alias(f"_place_{name}") for name in rules.order_by])

    def at(df: DataFrame, other: DataFrame) -> list[Column]:
        return [df[name].eqNullSafe(other[f"_place_{name}"]) for name in rules.order_by]

    repeated = firsts.join(other := places(written), at(firsts, other), "left_anti")
    repeated = places(repeated)
    inside = rejected(records, rules)
    inside = inside.join(repeated, at(inside, repeated), "left_anti")
    again = records.join(repeated, at(records, repeated), "left_semi").withColumn("reason", F.lit(DUPLICATE))
    return inside.unionByName(again)


def _start(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint_uri: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint_uri)
        .trigger(availableNow=True)
        .start()
    )


def keep_first_stream(
    stream: DataFrame, keys: list[str], order_by: list[str], table_uri: str, checkpoint_uri: str
) -> StreamingQuery:
    """Write the first row of each key to `table_uri`; null keys are equal to each other."""

    def each(batch: DataFrame, batch_id: int) -> None:
        _write_unseen(keep_first(batch, keys, order_by), keys, table_uri, batch_id)

    return _start(stream, each, checkpoint_uri)


def _clean_batch(
    records: DataFrame,
    rules: CleanRules,
    batch_id: int,
    table_uri: str,
    rejected_uri: str | None,
    audit_uri: str | None,
    also: dict[str, int],
    rankings: list[Ranking] | None = None,
    rankings_uri: str | None = None,
) -> None:
    """One batch into the table, the rejected rows, the audit and the rankings.

    What goes into the table is counted where it is written, which is once for each row. Rows that came in are
    counted by an aggregate: a metric observed ahead of a shuffle would count a task that is run again twice.
    """
    keys = ["_key"] if rules.long_keys else rules.keys
    filled = {f"n_fill_{t}": F.count_if(F.col("_valid") & (clean_text(F.col(t)) == "")) for t in rules.fill}
    counts = {"n_first": F.count(F.lit(1)), "n_valid": F.count_if("_valid"), **filled}
    firsts = first_complete(records, rules)
    written = _write_unseen(firsts, keys, table_uri, batch_id, counts if audit_uri else None)
    table = records.sparkSession.read.schema(firsts.schema).parquet(_batch_folder(table_uri, batch_id))
    if rankings:
        add_batch(finish(table, rules), batch_id, rankings, rankings_uri)
    if rejected_uri:
        write_table(_rejected(records, firsts, table, rules), _batch_folder(rejected_uri, batch_id))
    if audit_uri:
        came = stage(records, rules).agg(F.count(F.lit(1)).alias("n_all"), F.count_if(F.coalesce("_complete", F.lit(False))).alias("n_complete"))
        one = came.select(*[F.lit(value).cast("bigint").alias(name) for name, value in also.items()], "*")
        write_table(one.withColumns({name: F.lit(value).cast("bigint") for name, value in written.items()}), _batch_folder(audit_uri, batch_id))


def clean_stream(
    stream: DataFrame,
    rules: CleanRules,
    table_uri: str,
    checkpoint_uri: str,
    rejected_uri: str | None = None,
    audit_uri: str | None = None,
    rankings: list[Ranking] | None = None,
    rankings_uri: str | None = None,
) -> StreamingQuery:
    """Clean records as they arrive; read the result with `ingested` and the audit with `audited`.

    The table keeps the first complete row of each key with its validity flag, as an invalid first row still
    shadows later ones. Rows that a rule removes go to `rejected_uri` with the reason, and counts of each batch to
    `audit_uri`, where these are given; a batch that is run again replaces both. `rankings` are kept up to date
    below `rankings_uri`; read them with `rankings.current`.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        _clean_batch(batch, rules, batch_id, table_uri, rejected_uri, audit_uri, {}, rankings, rankings_uri)

    return _start(stream, each, checkpoint_uri)


def ingest_issues(
    spark: SparkSession,
    landing_uri: str,
    table_uri: str,
    documents_uri: str,
    checkpoint_uri: str,
    rules: CleanRules = FILE_RULES,
    files_per_batch: int | None = None,
    rejected_uri: str | None = None,
    audit_uri: str | None = None,
    rankings: list[Ranking] | None = None,
    rankings_uri: str | None = None,
) -> StreamingQuery:
    """Parse and clean each issue that arrives, as `clean_stream` does with records.

    Each document is parsed once, into `documents_uri`; `refused_documents` of that table is the quarantine.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        folder = _batch_folder(documents_uri, batch_id)
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("n_documents"), F.count("reason").alias("n_refused")]
        write_table(parse_payloads(batch).observe(seen, *counts), folder)
        documents = batch.sparkSession.read.parquet(folder)
        records = envelope_records(accepted(documents))
        _clean_batch(records, rules, batch_id, table_uri, rejected_uri, audit_uri, dict(seen.get), rankings, rankings_uri)

    return _start(stream_payloads(spark, landing_uri, True, files_per_batch), each, checkpoint_uri)


def ingested(spark: SparkSession, table_uri: str, rules: CleanRules = FILE_RULES) -> DataFrame:
    """Clean records of everything ingested so far."""
    return finish(spark.read.parquet(table_uri), rules)


def audited(spark: SparkSession, audit_uri: str, rules: CleanRules = FILE_RULES) -> DataFrame:
    """The audit of everything ingested so far, as `cleaning.audit` gives it for a batch job."""
    totals = spark.read.parquet(audit_uri)
    names = [name for name in totals.columns if name.startswith("n_")]
    return audit_rows(totals.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names]), rules)


def refused_documents(spark: SparkSession, landing_uri: str, documents_uri: str) -> DataFrame:
    """Quarantine of everything ingested so far, with the files of zero bytes, which no batch is given."""
    documents = refused(spark.read.parquet(documents_uri)).drop(BATCH)
    return documents.unionByName(empty_files(spark, landing_uri).withColumn("reason", F.lit(EMPTY)), allowMissingColumns=True)
