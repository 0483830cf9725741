"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks as index, shingles to verify.

An item of n words is looked for with windows of the largest multiple of 8 words that fits n - 7, one every 8 words
of a document. Any place where the item stands then holds a whole window, and the index has the fingerprints of all
windows of that size inside the item, so an unchanged passage meets its own fingerprint whatever its alignment.
Fingerprints have 128 bits in 16 blocks: two within 15 bits agree in one block at least.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm.common import mixed, shingles, steps, utf8, words

STRIDE = 8
RADIUS = 15
BLOCKS = 16
SHINGLE = 5
PERCENT = 80
# Words of benchmark items that are searched for in one pass; a larger benchmark takes more passes.
PASS_WORDS = 500_000


class Index(NamedTuple):
    """Fingerprints of item windows of one size, and for each block and value the places of those that have it.

    `stride` is the number of words from one window of a document to the next.
    """

    size: int
    stride: int
    low: np.ndarray
    high: np.ndarray
    item: np.ndarray
    at: np.ndarray
    begin: np.ndarray
    member: np.ndarray


class Items(NamedTuple):
    ids: list
    hashes: list[np.ndarray]
    sets: list[tuple[np.ndarray, np.ndarray]]
    indexes: list[Index]


def _signs(hashes: np.ndarray) -> np.ndarray:
    """128 bits for each word, as rows of 0 and 1."""
    two = np.stack([mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), mixed(hashes ^ np.uint64(0x14057B7EF767814F))], 1)
    return np.unpackbits(two.view(np.uint8).reshape(len(hashes), 16), axis=1)


def _prints(sums: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints (16 bytes) from the number of words that have each bit set."""
    return np.packbits(2 * sums > size, axis=1)


def weighted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and how often each occurs."""
    return np.unique(shingles(hashes, SHINGLE), return_counts=True)


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], percent: int = PERCENT) -> bool:
    """100 * sum of the smaller weights >= percent * sum of the larger ones."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    return 100 * low >= percent * (int(a[1].sum()) + int(b[1].sum()) - low) and low > 0


def windows_for(length: int) -> tuple[int, int]:
    """Size and stride of the windows that search for an item; for fewer than 15 words one of its size at every word."""
    return ((length - STRIDE + 1) // STRIDE * STRIDE, STRIDE) if length >= 2 * STRIDE - 1 else (length, 1)


def indexed(ids: list, texts: list[str]) -> Items:
    """Items with their index; items without words are left out."""
    own_ids, own, sets = [], [], []
    data, offsets = utf8(pa.array(texts, pa.string()))
    hashes, _, _, before = words(data, offsets)
    for k, item in enumerate(ids):
        h = hashes[before[k] : before[k + 1]]
        if len(h):
            own_ids.append(item)
            own.append(h)
            sets.append(weighted(h))
    indexes = []
    for size, stride in sorted({windows_for(len(h)) for h in own}):
        prints, item, at = [], [], []
        for k, h in enumerate(own):
            if windows_for(len(h)) == (size, stride):
                grown = np.vstack([np.zeros((1, 128), np.int32), np.cumsum(_signs(h), axis=0, dtype=np.int32)])
                rows = _prints(grown[size:] - grown[:-size], size)
                prints.append(rows)
                item += [k] * len(rows)
                at += range(len(rows))
        table = np.concatenate(prints)
        bucket = (np.arange(BLOCKS)[None, :] * 256 + table).ravel()
        order = np.argsort(bucket, kind="stable")
        begin = np.searchsorted(bucket[order], np.arange(BLOCKS * 256 + 1))
        low, high = np.ascontiguousarray(table.view(np.uint64).reshape(-1, 2).T)
        indexes.append(Index(size, stride, low, high, np.array(item), np.array(at), begin.astype(np.int32), (order // BLOCKS).astype(np.int32)))
    return Items(own_ids, own, sets, indexes)


def _near(prints: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (row of `prints`, entry of the index) within RADIUS bits: candidates agree in a block."""
    rows, entries = [], []
    low, high = np.ascontiguousarray(prints.view(np.uint64).reshape(-1, 2).T)
    for block in range(BLOCKS):
        bucket = block * 256 + prints[:, block].astype(np.int32)
        begin, count = index.begin[bucket], index.begin[bucket + 1] - index.begin[bucket]
        for part in range(0, len(prints), 1 << 13):
            own = slice(part, part + (1 << 13))
            c = count[own]
            grown = np.cumsum(c, dtype=np.int32)
            entry = index.member[np.repeat(begin[own] - grown + c, c) + np.arange(grown[-1], dtype=np.int32)]
            # half of the bits rule out nearly all candidates
            likely = np.flatnonzero(np.bitwise_count(np.repeat(low[own], c) ^ index.low[entry]) <= RADIUS)
            row, entry = part + np.searchsorted(grown, likely, "right"), entry[likely]
            close = np.bitwise_count(low[row] ^ index.low[entry]) + np.bitwise_count(high[row] ^ index.high[entry]) <= RADIUS
            rows.append(row[close])
            entries.append(entry[close])
    return np.concatenate(rows), np.concatenate(entries)


def _found(hashes: np.ndarray, before: np.ndarray, items: Items) -> list[dict[int, int]]:
    """For each document the items it holds, with the word where the best place of the item begins."""
    rows = len(before) - 1
    out: list[dict[int, int]] = [{} for _ in range(rows)]
    lengths = np.diff(before)
    blocks = -(-lengths // STRIDE)
    first = np.zeros(rows + 1, np.int64)
    np.cumsum(blocks, out=first[1:])
    # each document's words from a multiple of STRIDE on; the rest of its last block is empty
    signs = np.zeros((int(first[-1]) * STRIDE, 128), np.uint8)
    place = np.arange(len(hashes)) - np.repeat(before[:-1], lengths) + np.repeat(first[:-1] * STRIDE, lengths)
    signs[place] = _signs(hashes)
    sums = signs.reshape(-1, STRIDE, 128).sum(1, dtype=np.uint8)
    of_block = np.repeat(np.arange(rows), blocks)
    at_block = np.arange(int(first[-1])) - np.repeat(first[:-1], blocks)
    for index in items.indexes:
        if index.stride == STRIDE:
            wide = index.size // STRIDE
            if len(sums) < wide:
                continue
            grown = np.zeros((len(sums) - wide + 1, 128), np.uint16)
            for k in range(wide):
                grown += sums[k : k + len(grown)]
            whole = at_block[: len(grown)] * STRIDE + index.size <= lengths[of_block[: len(grown)]]
            starts, prints = np.flatnonzero(whole), _prints(grown[whole], index.size)
            doc, word = of_block[starts], at_block[starts] * STRIDE
        else:
            # short items: a window at every word
            total = np.vstack([np.zeros((1, 128), np.int32), np.cumsum(_signs(hashes), axis=0, dtype=np.int32)])
            starts = np.flatnonzero(np.arange(len(hashes)) + index.size <= np.repeat(before[1:], lengths))
            prints = _prints(total[starts + index.size] - total[starts], index.size)
            doc = np.repeat(np.arange(rows), lengths)[starts]
            word = starts - before[doc]
        if not len(starts):
            continue
        row, entry = _near(prints, index)
        tried = np.unique(np.stack([doc[row], index.item[entry], word[row] - index.at[entry]], 1), axis=0)
        for d, k, at in tried.tolist():
            own = items.hashes[k]
            if k not in out[d]:
                here = hashes[before[d] : before[d + 1]]
                for shift in sorted(range(-2, 3), key=abs):
                    begin = max(0, at + shift)
                    if similar(weighted(here[begin : begin + len(own)]), items.sets[k]):
                        out[d][k] = begin
                        break
    return out


def leaked_items(text: str, items: Items) -> Column:
    """array<struct<item_id, word>> of a text column: items it holds, by item_id. Null and empty texts hold none."""
    sent = SparkSession.active().sparkContext.broadcast(items)

    @F.pandas_udf("array<struct<item_id: bigint, word: bigint>>")
    def leaked(texts: pd.Series) -> pd.Series:
        own, out = sent.value, []
        data, offsets = utf8(pa.array(texts, pa.string(), from_pandas=True))
        for begin, end in steps(offsets, 1 << 18):
            hashes, _, _, before = words(data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin])
            if not len(hashes) or not own.indexes:
                out += [[] for _ in range(end - begin)]
                continue
            for found in _found(hashes, before, own):
                out.append([{"item_id": own.ids[k], "word": at} for k, at in sorted(found.items(), key=lambda x: own.ids[x[0]])])
        return pd.Series(out)

    return leaked(F.col(text))


def passes(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark as a query set in blocks of at most PASS_WORDS words by size of text, each with its index."""
    own = benchmark.where("item_id is not null").select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    # a word and its gap take two bytes at least
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-2 * total // (2 * PASS_WORDS)))
    for k in range(count):
        rows = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).orderBy("item_id", "text").collect()
        yield indexed([r["item_id"] for r in rows], [r["text"] for r in rows])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` with a column leaks: the benchmark items each text holds, as array<struct<item_id, word>>.

    An item is held when a run of as many words as it has, found through a fingerprint within RADIUS bits, has
    weighted shingles of five words (A-Z as a-z, each weighted by its number of occurrences) similar to the item's by
    80 in 100 or more; `word` is the first word of that run. Items of fewer than five words must occur in full. Null
    and empty texts hold none; items without words, or with a null item_id, are held by none. Items that share an
    item_id count as one and appear once for each of their texts.
    """
    out = docs.withColumn("leaks", F.array().cast("array<struct<item_id: bigint, word: bigint>>"))
    for k, items in enumerate(passes(benchmark)):
        out = out.withColumn("leaks", leaked_items("text", items) if k == 0 else F.array_sort(F.concat("leaks", leaked_items("text", items))))
    return out
