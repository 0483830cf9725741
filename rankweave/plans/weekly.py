"""The jobs of a weekly run, each reading tables the one before wrote.

    clean_issues   landing folder      -> clean, clean_tsv, rejected, audit, refused documents
    rank           clean table         -> count, metric and word tables
    compare        clean table         -> correlation matrix, split counts, model leaderboard
    chart_tables   stored results      -> chart tables

The caller gives the session and the URIs; any file system Spark knows will do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions.text import display_name
from rankweave.operators import cleaning, learning, ranking, report, statistics, words
from rankweave.schemas import CLEAN, LEADERBOARD, METRIC_NAMES, METRICS, TEXT_FIELDS
from rankweave.sinks import write_result, write_table, write_tsv
from rankweave.sources import envelopes
from rankweave.sources.tables import read_dictionary, read_result, read_tsv, read_word_list

ROW_KEYS = ["up", "title"]
TOP = 10


def _at(uri: str, name: str) -> str:
    return f"{uri.rstrip('/')}/{name}"


def clean_issues(spark: SparkSession, landing_uri: str, out_uri: str) -> DataFrame:
    """Clean all issues of a landing folder, one JSON file each; returns the clean table as written."""
    return clean_payloads(envelopes.read_payloads(spark, landing_uri), out_uri)


def clean_payloads(payloads: DataFrame, out_uri: str) -> DataFrame:
    """The same for a landing table `(file_name, payload)` whose file names (or URLs) are unique."""
    spark = payloads.sparkSession
    # Parsed once; records and the two lists of unusable documents are all read from this table.
    write_table(envelopes.parse_payloads(payloads), _at(out_uri, "documents"))
    documents = spark.read.parquet(_at(out_uri, "documents"))
    accepted = envelopes.accepted(documents)
    raw = envelopes.envelope_records(accepted)
    rules = cleaning.rules_for(raw)
    write_table(cleaning.clean(raw, rules), _at(out_uri, "clean"))
    write_table(cleaning.rejected(raw, rules), _at(out_uri, "rejected"))
    write_result(cleaning.audit(raw, rules), _at(out_uri, "audit"))
    write_table(envelopes.refused(documents), _at(out_uri, "refused"))
    write_table(envelopes.documents_without_items(accepted), _at(out_uri, "without_items"))
    clean = spark.read.schema(CLEAN).parquet(_at(out_uri, "clean"))
    write_tsv(clean, _at(out_uri, "clean_tsv"))
    return clean


def open_clean(spark: SparkSession, uri: str, view: str | None = "data") -> DataFrame:
    """Typed records from a tab-separated file, registered as a view for SQL users."""
    df = read_tsv(spark, uri)
    if view:
        df.createOrReplaceTempView(view)
    return df


def rank(
    clean: DataFrame, out_uri: str, stop_words_uri: str | None = None, dictionary_uri: str | None = None
) -> None:
    """Count, metric and word tables: two groupings, three metric passes and one text pass.

    Without a dictionary a word is a run of letters and digits; give one for texts without spaces.
    """
    spark = clean.sparkSession
    write_result(ranking.top_groups(clean, "up", TOP), _at(out_uri, "popular_up"))
    write_result(ranking.top_groups(clean, "tname", TOP), _at(out_uri, "popular_subject"))

    write_table(ranking.top_rows_by_metric(clean, ["title"], METRICS, TOP), _at(out_uri, "metric_rows"))
    write_table(ranking.top_group_sums_by_metric(clean, "up", METRICS, TOP), _at(out_uri, "metric_totals"))
    rows = spark.read.parquet(_at(out_uri, "metric_rows"))
    totals = spark.read.parquet(_at(out_uri, "metric_totals"))
    for metric in METRICS:
        best = rows.where(rows.metric == metric).orderBy("rank").limit(TOP)
        write_result(best.select("title", best.value.alias(metric)), _at(out_uri, f"{metric}_video"))
        largest = totals.where(totals.metric == metric).orderBy("rank").limit(TOP)
        write_result(largest.select("up", "total"), _at(out_uri, f"{metric}_up"))

    stop_words = read_word_list(spark, stop_words_uri)
    dictionary = read_dictionary(spark, dictionary_uri) if dictionary_uri else None
    weighted = report.word_weights(clean, TEXT_FIELDS, stop_words, dictionary=dictionary)
    write_table(weighted, _at(out_uri, "word_weights"))
    weights = spark.read.parquet(_at(out_uri, "word_weights"))
    for name in TEXT_FIELDS:
        top = words.top_words(weights.where(weights.field == name))
        write_result(top, _at(out_uri, f"{name}_wordcount"))


def compare(clean: DataFrame, out_uri: str, models: dict | None = None) -> None:
    """Rank correlation of the metrics, and the four classifiers of "reached the top ten"."""
    long = statistics.spearman(clean, METRICS)
    write_table(long, _at(out_uri, "correlation_long"))
    stored = clean.sparkSession.read.parquet(_at(out_uri, "correlation_long"))
    write_result(statistics.correlation_matrix(stored, METRICS), _at(out_uri, "correlation"))
    prepared = learning.prepare(clean, ROW_KEYS)
    write_result(learning.split_counts(prepared), _at(out_uri, "split_counts"))
    write_result(learning.leaderboard(prepared, models), _at(out_uri, "classifier_performance"))


def _stored_pages(spark: SparkSession, results_uri: str) -> DataFrame | None:
    """Pages of the metrics whose two results are both stored."""
    rows, totals = [], []
    for metric in METRICS:
        best = read_result(spark, _at(results_uri, f"{metric}_video"), "name string, value bigint")
        largest = read_result(spark, _at(results_uri, f"{metric}_up"), "name string, value bigint")
        if best is not None and largest is not None:
            rows.append(best.withColumn("metric", F.lit(metric)))
            totals.append(largest.withColumn("metric", F.lit(metric)))
    if not rows:
        return None
    ranked = [ranking.best_by_metric(report.union_all(parts), ["name"], "value", TOP) for parts in (rows, totals)]
    return report.page_series(ranked[0], "rows").unionByName(report.page_series(ranked[1], "totals"))


def chart_tables(spark: SparkSession, results_uri: str) -> dict[str, DataFrame]:
    """Chart tables by name, from stored results only. One whose result was never written is left out."""
    tables = {}
    pages = _stored_pages(spark, results_uri)
    if pages is not None:
        tables["metric_pages"] = pages.withColumn("metric_name", display_name(pages["metric"], METRIC_NAMES))
    for name, result, key in (("subject", "popular_subject", "tname"), ("up_count", "popular_up", "up")):
        shown = read_result(spark, _at(results_uri, result), f"{key} string, count bigint")
        if shown is not None:
            tables[name] = report.shown_page(shown, key)
    matrix_type = f"feature string, {', '.join(f'`{m}` double' for m in METRICS)}"
    matrix = read_result(spark, _at(results_uri, "correlation"), matrix_type)
    if matrix is not None:
        long = report.matrix_to_long(matrix, METRICS)
        tables["correlation"] = report.correlation_triples(long, METRIC_NAMES)
    board = read_result(spark, _at(results_uri, "classifier_performance"), LEADERBOARD)
    if board is not None:
        tables["classifier"] = report.leaderboard_series(board)
    for name in TEXT_FIELDS:
        counts = read_result(spark, _at(results_uri, f"{name}_wordcount"), "word string, count bigint")
        if counts is not None:
            tables[f"{name}_words"] = counts.where("word <> ''")
    return tables
