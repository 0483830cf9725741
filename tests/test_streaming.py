from __future__ import annotations

import collections
import json
import os

import pytest
from conftest import rows
from issues import write_issues
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.operators import cleaning, ranking, words
from rankweave.sources.envelopes import envelope_records, read_payloads, refused, split_payloads
from rankweave.storage import names_below
from rankweave.streaming import eventtime, ingest, rankings, runs
from rankweave.streaming.ingest import ingest_issues, ingested, keep_first_stream


def batch_result(spark, landing):
    accepted, _ = split_payloads(read_payloads(spark, str(landing)))
    return cleaning.clean(envelope_records(accepted))


def run(spark, tmp_path, landing, files_per_batch=None):
    uris = [str(tmp_path / name) for name in ("table", "documents", "checkpoint")]
    rejected = str(tmp_path / "rejected")
    ingest_issues(spark, str(landing), *uris, files_per_batch=files_per_batch, rejected_uri=rejected).awaitTermination()
    return uris


def raw_records(spark, landing):
    accepted, _ = split_payloads(read_payloads(spark, str(landing)))
    return envelope_records(accepted)


def test_one_batch_rejects_the_rows_of_the_batch_job(spark, tmp_path):
    landing = tmp_path / "landing"
    write_issues(landing, 6)
    run(spark, tmp_path, landing)
    columns = ["file_name", "pos", "reason"]
    got = spark.read.parquet(str(tmp_path / "rejected")).select(columns)
    assert rows(got) == rows(cleaning.rejected(raw_records(spark, landing), cleaning.FILE_RULES).select(columns))


def test_many_batches_lose_no_row(spark, tmp_path):
    landing = tmp_path / "landing"
    write_issues(landing, 6)
    table, _, _ = run(spark, tmp_path, landing, files_per_batch=2)
    places = ["file_name", "pos"]
    kept = spark.read.parquet(table).where("_valid").select(places)
    rejected = spark.read.parquet(str(tmp_path / "rejected")).select(places)
    assert rows(kept.union(rejected)) == rows(raw_records(spark, landing).select(places))


def test_a_small_batch_does_not_shuffle_the_history(spark):
    history = spark.range(200_000).withColumnRenamed("id", "k")
    batch = spark.createDataFrame([(5,), (None,), (300_000,)], "k long")
    unseen = ingest._unseen(batch, ["k"], history)
    assert rows(unseen.select("k")) == [(300_000,), (None,)]
    plan = unseen._jdf.queryExecution().sparkPlan().toString()
    semi = plan.index("LeftSemi")
    assert "BroadcastHashJoin" in plan[plan.rindex("\n", 0, semi) : semi]


def keys_by_batch(spark, tmp_path, batches, upto=None):
    """Batches of overlapping keys through the table; key k arrives in batches k // 10 and later."""
    table = str(tmp_path / "table")
    for batch in range(batches):
        firsts = spark.range(max(0, batch * 10 - 25), batch * 10 + 10, numPartitions=2).withColumnRenamed("id", "k")
        ingest._write_unseen(firsts, ["k"], table, batch)
    return table


def test_runs_read_for_a_batch_grow_with_the_logarithm(spark, tmp_path):
    table = keys_by_batch(spark, tmp_path, 18)
    assert rows(spark.read.parquet(table).select("k")) == [(k,) for k in sorted(range(180), key=lambda k: repr((k,)))]
    held = runs.Runs(spark, table, T.StructType().add("k", "long"))
    assert sorted(level for level, _ in held.before()) == [0, 0, 2]
    assert held.read(held.before()).count() == 180
    # notes of two batches and the runs they name are all that is kept
    assert len(names_below(spark, f"{table}/_notes")) == 2
    assert len(names_below(spark, f"{table}/_runs")) == 1


@pytest.mark.parametrize("failing", ["merge", "note"])
def test_a_batch_killed_while_it_merges_loses_nothing(spark, tmp_path, monkeypatch, failing):
    table = keys_by_batch(spark, tmp_path, 3)
    before = runs.Runs(spark, table, T.StructType().add("k", "long")).before()

    def killed(df, uri, *rest):
        if failing == "merge":
            df.limit(3).write.mode("overwrite").parquet(uri)  # half of the run is there
        raise KeyboardInterrupt

    def last(batch):
        ingest._write_unseen(spark.range(5, 40).withColumnRenamed("id", "k"), ["k"], table, batch)

    with monkeypatch.context() as patch:
        patch.setattr(runs, "write_table" if failing == "merge" else "write_note", killed)
        with pytest.raises(KeyboardInterrupt):
            last(3)
    held = runs.Runs(spark, table, T.StructType().add("k", "long"))
    assert held.before() == before
    for _ in range(2):  # the batch is run again, and once more
        last(3)
        assert [level for level, _ in held.before()] == [1]
        assert rows(held.read(held.before())) == rows(spark.range(40)) == rows(spark.read.parquet(table).select("k"))


def test_audit_of_all_batches_is_that_of_the_batch_job(spark, tmp_path):
    landing = tmp_path / "landing"
    write_issues(landing, 6)
    (landing / "issue_none.json").write_bytes(b"")
    for at, path in enumerate(sorted(landing.iterdir())):
        os.utime(path, (1_000_000 + at, 1_000_000 + at))
    audit, table, documents = (str(tmp_path / name) for name in ("audit", "table", "documents"))
    want = rows(cleaning.audit(raw_records(spark, landing), cleaning.FILE_RULES))
    for attempt in ("one", "two"):  # the second one replays all batches
        ingest_issues(spark, str(landing), table, documents, str(tmp_path / attempt), files_per_batch=2, audit_uri=audit).awaitTermination()
        assert rows(ingest.audited(spark, audit)) == want
        assert spark.read.parquet(audit).select("batch_id").distinct().count() == 4
        seen = spark.read.parquet(audit).agg(F.sum("n_documents"), F.sum("n_refused")).first()
        assert tuple(seen) == (7, 1)
    refused_files = ingest.refused_documents(spark, str(landing), documents).select("file_name", "reason")
    assert rows(refused_files) == [("issue_broken.json", "unparseable"), ("issue_none.json", "empty")]


def test_audit_of_a_batch_without_rows(spark, tmp_path):
    audit = str(tmp_path / "audit")
    records = raw_records(spark, write_issues(tmp_path / "landing", 1) and tmp_path / "landing").where("false")
    ingest._clean_batch(records, cleaning.FILE_RULES, 0, str(tmp_path / "table"), None, audit, {})
    assert rows(ingest.audited(spark, audit)) == rows(cleaning.audit(records, cleaning.FILE_RULES))


def test_one_batch_equals_the_batch_job(spark, tmp_path):
    landing = tmp_path / "landing"
    write_issues(landing, 6)
    table, documents, _ = run(spark, tmp_path, landing)
    assert rows(ingested(spark, table)) == rows(batch_result(spark, landing))
    quarantine = refused(spark.read.parquet(documents))
    assert rows(quarantine.select("file_name", "reason")) == [("issue_broken.json", "unparseable")]


def test_many_batches_keep_one_row_per_key_and_restart_adds_only_new(spark, tmp_path):
    landing = tmp_path / "landing"
    write_issues(landing, 4)
    table, _, _ = run(spark, tmp_path, landing, files_per_batch=2)
    staged = spark.read.parquet(table)
    assert staged.select("batch_id").distinct().count() >= 2
    assert staged.select("up", "title").distinct().count() == staged.count()

    write_issues(landing, 7)
    run(spark, tmp_path, landing, files_per_batch=2)
    staged = spark.read.parquet(table)
    assert staged.select("up", "title").distinct().count() == staged.count()
    accepted, _ = split_payloads(read_payloads(spark, str(landing)))
    firsts = cleaning.first_complete(envelope_records(accepted), cleaning.VIDEO_RULES)
    assert rows(staged.select("up", "title")) == rows(firsts.select("up", "title"))


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    source = tmp_path / "source"
    spark.range(100).selectExpr("id % 10 as k", "id as p").repartition(4).write.parquet(str(source))
    stream = spark.readStream.schema("k long, p long").option("maxFilesPerTrigger", 1).parquet(str(source))
    table = str(tmp_path / "table")
    for attempt in ("one", "two"):
        keep_first_stream(stream, ["k"], ["p"], table, str(tmp_path / attempt)).awaitTermination()
        assert rows(spark.read.parquet(table).select("k")) == [(k,) for k in range(10)]


RANKINGS = [
    rankings.group_counts("ups", "up", 4),
    rankings.group_sums("totals", "up", ["view", "like"], 3),
    rankings.best_rows("titles", ["title"], ["view", "coin"], 5),
    rankings.word_totals("words", ["title", "desc"], 6),
]


def batch_rankings(clean):
    return [
        ranking.top_groups(clean, "up", 4),
        ranking.top_group_sums_by_metric(clean, "up", ["view", "like"], 3),
        ranking.top_rows_by_metric(clean, ["title"], ["view", "coin"], 5),
        words.top_words(words.field_word_counts(clean, ["title", "desc"]), 6, "field"),
    ]


def test_rankings_after_each_batch_are_those_of_the_batch_job(spark, tmp_path):
    landing = tmp_path / "landing"
    write_issues(landing, 5)
    raw = raw_records(spark, landing)
    table, own = str(tmp_path / "table"), str(tmp_path / "rankings")
    assert rankings.current(spark, own, RANKINGS[0]) is None
    for batch in range(5):
        arrived = raw.where(F.regexp_extract("file_name", r"(\d+)", 1).try_cast("int") <= batch + 1)
        new = arrived.where(F.regexp_extract("file_name", r"(\d+)", 1).try_cast("int") == batch + 1)
        for _ in range(1 + (batch == 3)):  # the batch that merges is run twice
            ingest._clean_batch(new, cleaning.FILE_RULES, batch, table, None, None, {}, RANKINGS, own)
        if batch in (0, 3, 4):
            for got, want in zip(RANKINGS, batch_rankings(cleaning.clean(arrived, cleaning.FILE_RULES))):
                assert rows(rankings.current(spark, own, got)) == rows(want), (batch, got.name)
    assert len(names_below(spark, f"{own}/ups/_runs")) <= 1 + runs.FAN


def ordered_events(spark, tmp_path, batches):
    """A folder with one file of (key, seconds) for each batch, in their order."""
    source = tmp_path / "events"
    source.mkdir()
    for at, events in enumerate(batches):
        path = source / f"{at}.json"
        path.write_text("".join(json.dumps({"k": k, "s": s}) + "\n" for k, s in events))
        os.utime(path, (1_000_000 + at, 1_000_000 + at))
    stream = spark.readStream.schema("k string, s long").option("maxFilesPerTrigger", 1).json(str(source))
    return stream.withColumn("at", F.timestamp_seconds("s"))


def test_first_within_forgets_keys_and_counts_late_rows(spark, tmp_path):
    hour = 3600
    batches = [
        [("a", hour), ("a", hour + 5), ("b", hour), (None, hour), (None, hour)],
        [("a", hour + 100), ("c", 10 * hour)],
        [("c", 10 * hour + 1)],  # a row may be as late as the watermark of the batch before allows
        [("late", hour), ("a", 10 * hour), ("c", 10 * hour + 2)],  # a is forgotten by now, the first row is too late
        [("b", 1), (None, 10 * hour), ("d", None)],
    ]
    stream = ordered_events(spark, tmp_path, batches)
    table = str(tmp_path / "table")
    for attempt in range(2):  # the second run finds nothing new
        query = eventtime.first_within_stream(stream, ["k"], "at", "30 minutes", table, str(tmp_path / "checkpoint"))
        query.awaitTermination()
        assert eventtime.late_rows(query) == (3 if attempt == 0 else 0)
        assert collections.Counter(r["k"] for r in spark.read.parquet(table).collect()) == {"a": 2, "b": 1, "c": 1, None: 2}


def test_issues_by_event_time_equal_the_batch_job(spark, tmp_path):
    landing = tmp_path / "landing"
    write_issues(landing, 4)
    for at, path in enumerate(sorted(landing.iterdir())):
        if "broken" not in path.name:
            issue = json.loads(path.read_text(encoding="utf-8"))
            issue["data"]["config"]["etime"] = 1_600_000_000 + at * 7 * 86_400
            path.write_text(json.dumps(issue, ensure_ascii=False), encoding="utf-8")
        os.utime(path, (1_000_000 + at, 1_000_000 + at))
    table = str(tmp_path / "table")
    query = eventtime.ingest_issues_within(spark, str(landing), table, str(tmp_path / "checkpoint"), "52 weeks", files_per_batch=1)
    query.awaitTermination()
    staged = spark.read.parquet(table)
    # within a batch any row of a key may stay, so keys are compared
    firsts = cleaning.first_complete(raw_records(spark, landing), cleaning.FILE_RULES)
    assert rows(staged.select("up", "title")) == rows(firsts.select("up", "title"))
    assert eventtime.late_rows(query) == 0 and ingested(spark, table).count() > 0
