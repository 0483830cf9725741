from __future__ import annotations

import shutil

import pytest
from conftest import rows
from issues import write_issues
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression

from rankweave.operators import ranking, report
from rankweave.plans import weekly
from rankweave.schemas import METRICS, TEXT_FIELDS
from rankweave.sources import envelopes


@pytest.fixture(scope="module")
def week(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("week")
    written = write_issues(root / "landing")
    (root / "stop.txt").write_text("the\n中国\n", encoding="utf-8")
    clean = weekly.clean_issues(spark, str(root / "landing"), str(root / "out"))
    weekly.rank(clean, str(root / "results"), str(root / "stop.txt"))
    models = {
        "LogisticRegression": LogisticRegression(maxIter=5),
        "DecisionTree": DecisionTreeClassifier(),
    }
    weekly.compare(clean, str(root / "results"), models)
    return root, clean, written


def result(spark, root, name):
    return spark.read.csv(str(root / "results" / name), header=True, inferSchema=True)


def test_cleaning_conserves_rows(spark, week):
    root, clean, written = week
    rejected = spark.read.parquet(str(root / "out" / "rejected"))
    assert clean.count() + rejected.count() == written
    audit = spark.read.csv(str(root / "out" / "audit"), header=True, inferSchema=True).orderBy("step").collect()
    assert audit[0]["rows_in"] == written and audit[2]["rows_out"] == clean.count()
    refused = spark.read.parquet(str(root / "out" / "refused"))
    assert rows(refused.select("file_name")) == [("issue_broken.json",)]


def test_tab_separated_form_holds_the_same_rows(spark, week):
    root, clean, _ = week
    assert rows(weekly.open_clean(spark, str(root / "out" / "clean_tsv"))) == rows(clean)
    by_sql = spark.sql("SELECT up, COUNT(up) AS count FROM data GROUP BY up ORDER BY count DESC, up LIMIT 10")
    assert [tuple(r) for r in by_sql.collect()] == [tuple(r) for r in ranking.top_groups(clean, "up").collect()]


def test_metric_tables_keep_their_order(spark, week):
    root, clean, _ = week
    for metric in METRICS:
        got = [tuple(r) for r in result(spark, root, f"{metric}_video").collect()]
        assert got == [tuple(r) for r in ranking.top_rows(clean, metric, ["title"]).collect()]
        got = [tuple(r) for r in result(spark, root, f"{metric}_up").collect()]
        assert got == [tuple(r) for r in ranking.top_group_sums(clean, "up", metric).collect()]


def test_word_tables(spark, week):
    root, _, _ = week
    for name in TEXT_FIELDS:
        got = result(spark, root, f"{name}_wordcount").collect()
        counts = [r["count"] for r in got]
        assert 0 < len(got) <= 300 and counts == sorted(counts, reverse=True)
        assert all(len(str(r["word"])) >= 2 and r["word"] not in ("the", "中国") for r in got)


def test_comparison_tables(spark, week):
    root, _, _ = week
    matrix = result(spark, root, "correlation").collect()
    assert [r["feature"] for r in matrix] == METRICS
    for i, row in enumerate(matrix):
        assert row[i + 1] == 1.0
        assert all(row[j + 1] == matrix[j][i + 1] for j in range(len(METRICS)))
    board = result(spark, root, "classifier_performance").collect()
    assert [r["model"] for r in board] == ["LogisticRegression", "DecisionTree"]


def test_chart_tables(spark, week):
    root, clean, _ = week
    charts = weekly.chart_tables(spark, str(root / "results"))
    assert set(charts) == {"metric_pages", "subject", "up_count", "correlation", "classifier"} | {f"{f}_words" for f in TEXT_FIELDS}
    assert charts["correlation"].count() == 49
    assert charts["classifier"].count() == 4
    pages = charts["metric_pages"].drop("metric_name")
    assert rows(pages) == rows(report.metric_pages(clean, METRICS, "title", "up")) and pages.where("series = 'rows'").count() == 70
    assert rows(charts["up_count"]) == rows(report.count_page(clean, "up"))
    assert rows(charts["subject"]) == rows(report.count_page(clean, "tname"))
    assert "播放量" in [r["label_i"] for r in charts["correlation"].collect()]


def test_missing_results_are_left_out(spark, week, tmp_path):
    root, _, _ = week
    assert weekly.chart_tables(spark, str(tmp_path)) == {}
    for name in ("view_video", "like_video", "like_up", "popular_up"):
        shutil.copytree(root / "results" / name, tmp_path / name)
    charts = weekly.chart_tables(spark, str(tmp_path))
    assert set(charts) == {"metric_pages", "up_count"}
    assert {r["metric"] for r in charts["metric_pages"].collect()} == {"like"}


def test_split_counts_are_stored(spark, week):
    root, clean, _ = week
    counts = {r["part"]: r["rows"] for r in result(spark, root, "split_counts").collect()}
    assert set(counts) == {"train", "test"} and sum(counts.values()) == clean.count() and min(counts.values()) > 0


def test_a_landing_table_gives_the_same_rows_as_files(spark, week, tmp_path):
    root, clean, _ = week
    landing = str(tmp_path / "landing")
    envelopes.read_payloads(spark, str(root / "landing")).repartition(5).write.parquet(landing)
    assert rows(weekly.clean_payloads(spark.read.parquet(landing), str(tmp_path / "out"))) == rows(clean)


def test_files_of_equal_name_lose_no_row(spark, tmp_path):
    import json

    from rankweave.operators import cleaning
    from rankweave.sources import envelopes

    stat = {name: 1 for name in (*cleaning.METRICS, cleaning.BEST_RANK)} | {cleaning.DISLIKE: 0}
    item = {"title": "t", "tname": "n", "desc": "", "rcmd_reason": "", "owner": {"name": "u"}, "stat": stat}
    for year in ("2019", "2020"):
        folder = tmp_path / year
        folder.mkdir()
        (folder / "week_1.json").write_text(json.dumps({"data": {"config": {"name": year}, "list": [item]}}))
    raw = envelopes.envelope_records(envelopes.split_payloads(envelopes.read_payloads(spark, f"{tmp_path}/*/*.json"))[0])
    rules = cleaning.rules_for(raw)
    assert [row["period"] for row in cleaning.clean(raw, rules).collect()] == ["2019"]
    assert [(row["period"], row["reason"]) for row in cleaning.rejected(raw, rules).collect()] == [("2020", cleaning.DUPLICATE)]
