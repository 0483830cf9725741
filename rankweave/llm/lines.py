"""Repeated lines: windows of three lines that occur again are removed after their first place."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.common import kept

LINES = 3


def _without(text: pd.Series, starts: pd.Series, size: pd.Series) -> pd.DataFrame:
    """The text without the lines that windows at `starts` cover."""
    out = []
    for body, at, width in zip(text, starts, size):
        if body is None:
            out.append((0, 0, None))
            continue
        lines = body.split("\n")
        if at is None or not len(at):
            out.append((len(lines), 0, body))
            continue
        covered = {k for start in at for k in range(start, start + width)}
        left = [line for k, line in enumerate(lines) if k not in covered]
        out.append((len(lines), len(covered), "\n".join(left)))
    return pd.DataFrame(out, columns=["lines", "removed", "text"])


def line_windows(docs: DataFrame, size: int = LINES) -> DataFrame:
    """doc_id, text_key, pos and two 64-bit hashes a, b of every run of `size` lines. Fewer lines have no window."""
    lines = docs.select("doc_id", "text_key", F.split("text", "\n", -1).alias("lines"))
    lines = lines.where(F.size("lines") >= size)
    lines = lines.select(
        "doc_id", "text_key",
        F.transform("lines", lambda x: F.xxhash64(x)).alias("a"),
        F.transform("lines", lambda x: F.xxhash64(F.lit(17), x, F.lit(5))).alias("b"),
    )
    joined = lambda c: F.transform(
        F.sequence(F.lit(0), F.size(c) - size), lambda i: F.xxhash64(*[F.get(F.col(c), i + k) for k in range(size)])
    )
    zipped = lines.select("doc_id", "text_key", F.posexplode(F.arrays_zip(joined("a").alias("a"), joined("b").alias("b"))).alias("pos", "w"))
    return zipped.select("doc_id", "text_key", "pos", "w.a", "w.b")


def without_repeated_lines(docs: DataFrame, size: int = LINES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, n_lines, n_removed, kept_text.

    Lines are what stands between line feeds. Every run of `size` lines is a window; of equal windows the first stays
    (smallest doc_id, then place) and all lines that a later one covers go, also where windows overlap. Windows are
    judged on the input. A text of fewer lines stays whole, an empty one has one empty line, null has none and stays
    null. A null doc_id comes before all others. Rows that repeat a doc_id are ordered by a hash of their text; rows
    that repeat both are one document given twice.
    """
    own = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    own = own.withColumn("text_key", F.xxhash64("text"))
    windows = kept(line_windows(own, size), "line-windows")
    place = F.struct("doc_id", "text_key", "pos")
    firsts = windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    firsts = firsts.where(~F.col("first").eqNullSafe(F.col("last")))
    later = windows.join(firsts.select("a", "b", "first"), ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    starts = later.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("starts"))
    starts = starts.withColumnsRenamed({"doc_id": "start_id", "text_key": "start_key"})
    same = own["doc_id"].eqNullSafe(starts["start_id"]) & (own["text_key"] == starts["start_key"])
    without = F.pandas_udf(_without, "lines int, removed int, text string")
    cut = own.join(starts, same, "left").select("doc_id", without("text", "starts", F.lit(size)).alias("out"))
    return cut.select(
        "doc_id", F.col("out.lines").cast("bigint").alias("n_lines"), F.col("out.removed").cast("bigint").alias("n_removed"),
        F.col("out.text").alias("kept_text"),
    )
