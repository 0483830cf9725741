"""Word counts: tokenise, count, leave out stop words, take the most frequent."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankweave.functions.text import strip_unicode, words


def tokenize(df: DataFrame, text: str, keep: list[str] | None = None, min_length: int = 2) -> DataFrame:
    """One row `(*keep, word)` per run of letters and digits. Case is kept.

    `length` counts code points, so the filter also drops runs of one letter; '' goes with them.
    """
    rows = df.select(*(keep or []), F.explode(words(F.col(text))).alias("word"))
    return rows.where(F.length("word") >= max(min_length, 1))


def tokenize_with(
    df: DataFrame,
    text: str,
    cut: Callable[[str], Iterable[str]],
    keep: list[str] | None = None,
    min_length: int = 2,
) -> DataFrame:
    """Like `tokenize`, with a caller's segmenter, given one text and run on Arrow batches.

    Marked as not deterministic, or the filter that an explode adds would call it a second time.
    """
    @F.pandas_udf("array<string>")
    def cut_batch(texts: pd.Series) -> pd.Series:
        return texts.map(lambda value: list(cut(value)) if value else [])

    rows = df.select(*(keep or []), F.explode(cut_batch.asNondeterministic()(F.col(text))).alias("word"))
    return rows.withColumn("word", strip_unicode(F.col("word"))).where(F.length("word") >= max(min_length, 1))


def tokenize_by(
    df: DataFrame,
    text: str,
    segmenter: Callable[[], Callable[[str], Iterable[str]]],
    keep: list[str] | None = None,
    min_length: int = 2,
) -> DataFrame:
    """Like `tokenize`, with a segmenter that is costly to make: `segmenter` is called once in each task.

    A table function yields the words of a text as rows, so that those of a long text are never held as one array.
    """

    class Words:
        def __init__(self):
            self.cut = segmenter()

        def eval(self, value: str):
            for word in self.cut(value) if value else ():
                yield (word,)

    keep = keep or []
    words_of = F.udtf(Words, returnType="word string")
    rows = df.select(*keep, F.col(text).alias("_text"))
    rows = rows.lateralJoin(words_of(F.col("_text").outer())).select(*keep, strip_unicode(F.col("word")).alias("word"))
    return rows.where(F.length("word") >= max(min_length, 1))


def word_counts(tokens: DataFrame, by: list[str] | None = None) -> DataFrame:
    """`(*by, word, count)`. Partial sums before the shuffle keep a frequent word to one row per task."""
    return tokens.groupBy(*(by or []), "word").agg(F.count(F.lit(1)).alias("count"))


def drop_stop_words(counts: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Counts of words that are not in `stop_words`; case matters.

    Done after counting: each word is then one row on either side (per group), so the join cannot be
    skewed and needs no hint. Spark moves it in front of the counting when the stop words are few
    enough to broadcast, and so takes the most frequent words out before the shuffle.
    """
    return counts.join(stop_words.select("word").distinct(), "word", "left_anti")


def top_words(counts: DataFrame, k: int = 300, by: str | None = None) -> DataFrame:
    """The k most frequent words, ties by word; with `by`, k for each of its values."""
    order = [F.col("count").desc(), F.col("word").asc()]
    if by is None:
        return counts.select("word", "count").orderBy(*order).limit(k)
    window = Window.partitionBy(by).orderBy(*order)
    ranked = counts.withColumn("_nth", F.row_number().over(window)).where(F.col("_nth") <= k)
    return ranked.select(by, "word", "count")


def by_field(df: DataFrame, fields: list[str]) -> DataFrame:
    """`(field, text)`: several text columns as rows, from one pass over the table."""
    texts = [F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields]
    return df.select(F.inline(F.array(*texts)))


def field_word_counts(df: DataFrame, fields: list[str], min_length: int = 2) -> DataFrame:
    """`(field, word, count)` for several text columns."""
    return word_counts(tokenize(by_field(df, fields), "text", ["field"], min_length), ["field"])
