"""Token counts: an exact histogram of encoded lengths, with suffix sums that answer every context limit."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankweave.llm.common import kept

TOKENIZERS = "/opt/tokenizers"
# Lengths in one window task; the sums of the ranges below and above come from one row per range.
RANGE = 256
# Fixed value: the pattern that cuts text before byte pairs are merged.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: white space as that pattern has it.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Characters of white space in a row that are encoded apart, as the pattern's search goes too deep on very long ones.
LONG_RUN = 10_000


def _pieces_of_long_runs(text: str) -> list[tuple[str, bool]]:
    """A text cut around long runs of white space, where the pattern cuts it too; True marks a part that is one run.

    The pattern takes a run at the end of a text whole, and leaves the last character of any other to what follows.
    """
    out, at = [], 0
    for run in re.finditer(rf"[{WHITE}]{{{LONG_RUN},}}", text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += [(text[at : run.start()], False), (text[run.start() : end], True)]
        at = end
    return [*out, (text[at:], False)]


def counter(path: str) -> Callable[[str | None], int]:
    """A function that counts the tokens of a text under a vocabulary file."""
    encoding = _encoding(path)

    def count(text: str | None) -> int:
        if not text:
            return 0
        if len(text) < LONG_RUN:
            return len(encoding.encode_ordinary(text))
        parts = _pieces_of_long_runs(text)
        return sum(len(encoding._encode_single_piece(part) if run else encoding.encode_ordinary(part)) for part, run in parts)

    return count


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> Column:
    """Tokens of a text column under a byte-pair vocabulary file that every executor has. Null and empty have none.

    Any text is counted whole, also one that is a single word or a single run of white space.
    """

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(list(map(counter(vocabulary), texts)), dtype="int64")

    return count(F.col(text))


def length_histogram(docs: DataFrame, length: Column) -> DataFrame:
    """length, n_docs: how many rows have each length; hot lengths are counted before the shuffle."""
    return docs.select(length.cast("bigint").alias("length")).groupBy("length").agg(F.count("*").alias("n_docs"))


def limit_answers(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as context limit, what it does to the corpus.

    length, n_docs, n_tokens (of this length alone), docs_up_to, docs_at_least and tokens_at_least (suffix sums),
    total_docs, total_tokens, truncated_total (tokens left when every text is cut to the limit) and docs_cut. A limit
    that does not occur lies between two rows: see `truncated_at`. An empty histogram gives no rows. Sums run inside
    ranges of 256 lengths; only one row per range is summed in one task. The histogram is written once, as its
    rows are read for the ranges and for the sums, and the texts would be encoded for each.
    """
    histogram = kept(histogram, "length-histogram")
    rows = histogram.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"))
    rows = rows.withColumn("part", F.floor(F.col("length") / RANGE))
    parts = rows.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    above = W.orderBy(F.desc("part")).rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    parts = parts.select(
        "part",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(every).alias("total_docs"),
        F.sum("t").over(every).alias("total_tokens"),
    )
    inside = W.partitionBy("part").orderBy(F.desc("length")).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumns({"docs_in": F.sum("n_docs").over(inside), "tokens_in": F.sum("n_tokens").over(inside)})
    rows = rows.join(parts, "part")
    docs_at_least, tokens_at_least = F.col("docs_in") + F.col("docs_above"), F.col("tokens_in") + F.col("tokens_above")
    longer = docs_at_least - F.col("n_docs")
    return rows.select(
        "length", "n_docs", "n_tokens",
        (F.col("total_docs") - longer).alias("docs_up_to"), docs_at_least.alias("docs_at_least"),
        tokens_at_least.alias("tokens_at_least"), "total_docs", "total_tokens",
        (F.col("total_tokens") - tokens_at_least + F.col("length") * docs_at_least).alias("truncated_total"),
        longer.alias("docs_cut"),
    )


def length_quantiles(answers: DataFrame, shares: list[float]) -> DataFrame:
    """share, length: the smallest length that at least `share` of the documents do not exceed."""
    asked = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    rows = answers.select("length", "docs_up_to", "total_docs", asked)
    return rows.where(F.col("docs_up_to") >= F.ceil(F.col("share") * F.col("total_docs"))).groupBy("share").agg(F.min("length").alias("length"))


def truncated_at(answers: DataFrame, limits: list[int]) -> DataFrame:
    """limit, truncated_total, docs_cut for any limits, from the next longer length that occurs or, past all, the total."""
    asked = F.explode(F.array(*[F.lit(int(x)).cast("bigint") for x in limits])).alias("limit")
    rows = answers.select("length", "docs_at_least", "tokens_at_least", "total_tokens", asked)
    cut = F.when(F.col("length") > F.col("limit"), F.struct("length", "docs_at_least", "tokens_at_least"))
    rows = rows.groupBy("limit").agg(F.min(cut).alias("next"), F.first("total_tokens").alias("total"))
    docs_cut = F.coalesce(F.col("next.docs_at_least"), F.lit(0))
    tokens = F.coalesce(F.col("next.tokens_at_least"), F.lit(0))
    return rows.select("limit", (F.col("total") - tokens + F.col("limit") * docs_cut).alias("truncated_total"), docs_cut.alias("docs_cut"))
