"""Text tables: headerless tab-separated records, headered CSV results, word lists."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions.numeric import all_of, once
from rankweave.functions.text import strip_unicode
from rankweave.schemas import CLEAN


def _split_lines(spark: SparkSession, uri: str, schema: T.StructType) -> tuple[DataFrame, Column, Column]:
    """Lines with their fields, and the two checks: field count, and every non-text field parses.

    Not the CSV reader: titles are free text, and a field that starts with a quote would swallow
    the tabs after it.
    """
    lines = spark.read.text(uri).select("value", once(F.split("value", "\t", -1)).alias("fields"))
    right_size = F.size("fields") == len(schema)
    parses = all_of(
        [
            _typed(index, field).isNotNull()
            for index, field in enumerate(schema)
            if not isinstance(field.dataType, T.StringType)
        ]
    )
    return lines, right_size, parses


def _typed(index: int, field: T.StructField) -> Column:
    value = F.get("fields", index)
    return value if isinstance(field.dataType, T.StringType) else value.try_cast(field.dataType)


def read_tsv(spark: SparkSession, uri: str, schema: T.StructType = CLEAN) -> DataFrame:
    """Typed rows of the lines that fit the schema by position."""
    lines, right_size, parses = _split_lines(spark, uri, schema)
    return lines.where(right_size & parses).select(
        *[_typed(index, field).alias(field.name) for index, field in enumerate(schema)]
    )


def read_tsv_rejects(spark: SparkSession, uri: str, schema: T.StructType = CLEAN) -> DataFrame:
    """`(line, reason)` of the lines `read_tsv` leaves out."""
    lines, right_size, parses = _split_lines(spark, uri, schema)
    return lines.where(~(right_size & parses)).select(
        F.col("value").alias("line"),
        F.when(~right_size, "field_count").otherwise("not_a_number").alias("reason"),
    )


def read_result(spark: SparkSession, uri: str, schema: T.StructType) -> DataFrame | None:
    """A headered CSV result, or None when it was never written; the caller then skips it."""
    try:
        # A null value other than '' tells quoted empty text from a field that is not there.
        return spark.read.csv(uri, schema=schema, header=True, escape='"', multiLine=True, nullValue="\x00")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_word_list(spark: SparkSession, uri: str | None) -> DataFrame:
    """Distinct stripped non-empty lines as column `word`; no rows when there is no such file."""
    empty = spark.createDataFrame([], "word string")
    if uri is None:
        return empty
    try:
        lines = spark.read.text(uri)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise
    return lines.select(strip_unicode(F.col("value")).alias("word")).where("word <> ''").distinct()


def read_dictionary(spark: SparkSession, uri: str) -> DataFrame:
    """`(word, freq)` from lines `word freq` or `word freq tag`; a word without a number counts once."""
    parts = F.split(strip_unicode(F.col("value")), r"\s+")
    lines = spark.read.text(uri).select(once(parts).alias("parts"))
    freq = F.coalesce(F.get("parts", 1).try_cast("bigint"), F.lit(1))
    return lines.select(F.get("parts", 0).alias("word"), freq.alias("freq")).where("word <> ''")
