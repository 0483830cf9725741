"""Near duplicates: universal hash minima in bands find candidates, full shingle sets confirm them, stars join them.

Documents with equal shingle sets are one class from the start. In a bucket all classes are first compared with one
member, the centre. Classes of a bucket that are in different components after that are compared with each other, by
signature and then by full sets, and only confirmed pairs leave the task: a large group of near copies is not expanded
into all its pairs, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankweave.llm.common import kept, mixed, shingles, steps, utf8, words
from rankweave.llm.components import components

# Minima per band and number of bands: a pair at similarity 0.8 misses every band with probability 5e-7.
ROWS = 6
BANDS = 48
# Members of a bucket in one block, where members of different components are compared with each other.
BLOCK = 2048
_PART = 2048
_random = np.random.default_rng(8)
_FACTOR = _random.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADDED = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """Minima of all universal hashes (odd factor and summand modulo 2 ** 32) over a set of 64-bit shingle hashes."""
    x = (shingle_set >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_FACTOR), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), _PART):
        hashed = x[None, k : k + _PART] * _FACTOR[:, None]
        hashed += _ADDED[:, None]
        np.minimum(least, hashed.min(1), out=least)
    return least


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key for each band."""
    parts = signature.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return key.view(np.int64)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = utf8(column)
    for first, last in steps(offsets):
        begin = offsets[first]
        hashes, _, _, before = words(data[begin : offsets[last]], offsets[first : last + 1] - begin)
        for k in range(last - first):
            yield np.unique(shingles(hashes[before[k] : before[k + 1]], size))


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the set) and bands (bucket keys; none for an empty set)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, keys, bands, places = [], [], [], [0]
            for own in shingle_sets(batch.column(1), size):
                count.append(len(own))
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).hexdigest() if len(own) else None)
                if len(own):
                    bands.append(band_keys(signature(own)))
                places.append(places[-1] + (BANDS if len(own) else 0))
            flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(keys, pa.string()), lists], ["doc_id", "n_shingles", "set_key", "bands"]
            )

    return docs.mapInArrow(sketch, "doc_id bigint, n_shingles bigint, set_key string, bands array<bigint>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id and shingles: the full set as bytes of sorted 64-bit hashes."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [x.tobytes() for x in shingle_sets(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], ["doc_id", "shingles"])

    return docs.mapInArrow(sets, "doc_id bigint, shingles binary")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted sets."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    merged = np.concatenate([x, y])
    merged.sort(kind="stable")
    shared = int((merged[1:] == merged[:-1]).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                close.append(_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent))
            yield batch.select([0, 1]).filter(pa.array(close, pa.bool_()))

    rows = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    rows = rows.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    return rows.mapInArrow(check, "a bigint, b bigint")


def _members(heads: DataFrame) -> DataFrame:
    """bucket, doc_id, place: rows of all buckets that more than one document shares.

    In a bucket those with the most partners over all their buckets come first: the text that copies were made from
    shares more with them than they share with each other.
    """
    buckets = heads.select("doc_id", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = kept(buckets.join(shared, "bucket"), "members")
    partners = members.groupBy("doc_id").agg(F.sum(F.col("size") - 1).alias("partners"))
    order = W.partitionBy("bucket").orderBy(F.desc("partners"), "doc_id")
    ranked = members.join(partners, "doc_id").select("bucket", "doc_id", (F.row_number().over(order) - 1).alias("place"))
    return kept(ranked, "members")


def _star_pairs(members: DataFrame) -> DataFrame:
    """(a, b): the first member of each bucket with all others of it."""
    centre = members.where("place = 0").select("bucket", F.col("doc_id").alias("a"))
    return members.where("place > 0").join(centre, "bucket").select("a", F.col("doc_id").alias("b")).distinct()


def _apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with their component, of buckets that hold several; centres, which were compared with all, are left out."""
    node = found.select(F.col("node").alias("doc_id"), "component")
    rows = members.where("place > 0").join(node, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    several = rows.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.floor(F.max("place") / BLOCK).alias("blocks")
    )
    return rows.join(several.where("low <> high").select("bucket", "blocks"), "bucket")


def _compared(apart: DataFrame, sets: DataFrame, bands: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of different components in a bucket whose full sets are similar; some of those that earlier ones imply are left out.

    A bucket is compared in pairs of blocks of BLOCK members. Only sets whose signatures agree as those of similar
    sets do are read (the share of equal minima may lie four deviations below the limit), and of the buckets that a
    pair shares only the first one reads it.
    """
    hashes, share = BANDS * ROWS, percent / 100
    limit = hashes * share - 4 * (hashes * share * (1 - share)) ** 0.5

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [signature(np.frombuffer(x, np.uint64)).astype(np.uint8).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.binary())], ["doc_id", "shingles", "bands", "minima"])

    def compare(block: pa.Table) -> pa.Table:
        ids, groups, keys = (block.column(c).to_numpy().copy() for c in ("doc_id", "component", "bucket"))
        side = block.column("side").to_numpy()
        minima = np.stack([np.frombuffer(x, np.uint8) for x in block.column("minima").to_pylist()])
        bands = block.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), BANDS)
        sets = [np.frombuffer(x, np.uint64) for x in block.column("shingles").to_pylist()]
        a, b = [], []
        two = len(np.unique(side)) > 1
        band = int(np.argmax(bands[0] == keys[0]))
        for k in np.flatnonzero(side == side.min()):
            other = np.flatnonzero(side != side[k]) if two else np.arange(k + 1, len(ids))
            other = other[groups[other] != groups[k]]
            other = other[~(bands[other, :band] == bands[k, :band]).any(1)]
            other = other[(minima[other] == minima[k]).sum(1, dtype=np.uint16) >= limit]
            for x in other:
                if groups[x] != groups[k] and _similar(sets[k], sets[x], percent):
                    a.append(ids[k])
                    b.append(ids[x])
                    groups[groups == groups[x]] = groups[k]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    asked = sets.join(apart.select("doc_id").distinct(), "doc_id", "left_semi").join(bands.dropDuplicates(["doc_id"]), "doc_id")
    signs = asked.select("doc_id", "shingles", "bands").mapInArrow(signed, "doc_id bigint, shingles binary, bands array<bigint>, minima binary")
    side = F.floor(F.col("place") / BLOCK)
    rows = apart.withColumn("side", side).withColumn("meets", F.expr("explode(sequence(0L, blocks))"))
    rows = rows.withColumns({"low": F.least("side", "meets"), "high": F.greatest("side", "meets")}).drop("place", "blocks", "meets")
    rows = rows.join(signs, "doc_id")
    return rows.groupBy("bucket", "low", "high").applyInArrow(compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id, kept.

    Words are what stands between ASCII white space, with A-Z as a-z; a set holds the distinct shingles of `size`
    words, or all words as one shingle where there are fewer. Documents are linked when their sets overlap by
    `percent` of the union or more; component_id is the smallest doc_id that links reach, and the document with that
    doc_id is kept. Null and empty texts have no shingle and are linked with nothing. Rows that share a doc_id are one
    node. A null doc_id is linked with nothing and kept.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = kept(sketched(own, size), "sketches")
    named = rows.where("doc_id is not null and set_key is not null")
    classes = kept(named.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")), "set-classes")
    same = named.select("doc_id", "set_key").join(classes.where("first_id <> last_id"), "set_key").where("doc_id <> first_id")
    same = same.select(F.col("doc_id").alias("a"), F.col("first_id").alias("b"))

    heads = named.join(classes.select("set_key", F.col("first_id").alias("doc_id")), ["set_key", "doc_id"], "left_semi")
    members = _members(heads)
    sets = kept(_sets(own.join(members.select("doc_id").distinct(), "doc_id", "left_semi"), size), "sets")
    links = same.unionByName(kept(_confirmed(_star_pairs(members), sets, percent), "confirmed"))
    found = components(links)
    more = kept(_compared(_apart(members, found), sets, heads.select("doc_id", "bands"), percent), "confirmed")
    if not more.isEmpty():
        found = components(links.unionByName(more))

    out = rows.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
