"""Writers. All replace what is at the URI, so a job that is run again gives the same files.

What is there stays readable until the new files are complete: they are written beside it and put in its place by
renaming. A write that fails leaves the old files as they were.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.storage import names_below, remove, rename

# Names of folders beside a result that its readers do not see, as Spark passes over names with a leading dot.
STAGED, REPLACED = "staged", "replaced"


def _beside(uri: str) -> tuple[str, str]:
    parent, name = uri.rstrip("/").rsplit("/", 1)
    return parent, name


def restore(spark: SparkSession, uri: str) -> None:
    """Bring back the old files of a result whose replacement stopped between its two renamings."""
    parent, name = _beside(uri)
    names = names_below(spark, parent)
    old = [x for x in names if x.startswith(f".{name}.{REPLACED}-")]
    if name not in names and old:
        rename(spark, f"{parent}/{old[0]}", uri)


def _publish(spark: SparkSession, uri: str, write: Callable[[str], None]) -> None:
    uri = uri.rstrip("/")
    parent, name = _beside(uri)
    restore(spark, uri)
    staged, replaced = (f"{parent}/.{name}.{kind}-{uuid.uuid4().hex}" for kind in (STAGED, REPLACED))
    try:
        write(staged)
    except BaseException:
        remove(spark, staged)
        raise
    if name in names_below(spark, parent):
        rename(spark, uri, replaced)
    rename(spark, staged, uri)
    remove(spark, replaced)


def write_table(df: DataFrame, uri: str, by: list[str] | None = None) -> None:
    """Parquet, the form every later job reads; with `by` in a folder for each value of these columns."""
    _publish(df.sparkSession, uri, lambda to: df.write.parquet(to, partitionBy=by))


def tsv_line(df: DataFrame) -> Column:
    """One tab-separated text per row. The fields must be cleaned and not null."""
    return F.concat_ws("\t", *[F.col(f"`{name}`").cast("string") for name in df.columns])


def write_tsv(df: DataFrame, uri: str) -> None:
    """Headerless tab-separated text, UTF-8, LF."""
    _publish(df.sparkSession, uri, df.select(tsv_line(df).alias("value")).write.text)


def write_result(df: DataFrame, uri: str) -> None:
    """A headered CSV for a report-sized result, in one part so that its row order is kept.

    Only for results with a row limit of their own (top-k tables, matrices, leaderboards). Empty text
    is written quoted and null is not, so the two come back as they were.
    """
    _publish(df.sparkSession, uri, lambda to: df.coalesce(1).write.csv(to, header=True, escape='"'))
