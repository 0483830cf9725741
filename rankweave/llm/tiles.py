"""Exact set similarity join: documents meet in tiles of a size band, bitmaps bound their overlap, sorted sets decide.

The 64-bit hashes of a set are cut into ranges, as many for every set of a band. Two sets that differ in d elements
differ in at most d ranges, so of the first d + 1 + h ranges that hold anything at least h + 1 are equal in both: a set
goes to the tiles of its first ranges, keyed by band, range and content, and leaves the h tiles that most sets share.
The rarest tile that two similar sets share is none of those. In a tile the bitmaps are compared by counting bits, which
bounds the overlap from above, and only pairs that pass are confirmed on the sorted sets. Equal sets are one class from
the start. Every set is first compared with one other that shares tiles with many; after that only sets in different
components are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankweave.llm.common import kept, mixed
from rankweave.llm.components import components
from rankweave.llm.minhash import shingle_sets

# Sizes of a band run from its limit up to this many times it.
BAND = 1.5
# Tiles that a set keeps in a band at most. A similar pair that needs more ranges for certainty shares each range with a probability of
# over 1/2 (of hashes), and misses all of so many with less than 1e-19: less than that of two equal 64-bit hashes.
MOST_TILES = 64
# Bytes of bitmaps that one side of a comparison may hold.
SIDE_BYTES = 4 << 20
# Members of a tile in one side of a comparison.
SIDE_ROWS = 4096


def band_of(size: int) -> int:
    """Band 0 holds sizes up to 8; each further one sizes up to 1.5 times as large."""
    return 0 if size <= 8 else int(np.ceil(np.log(size / 8) / np.log(BAND) - 1e-9))


def ranges_of(band: int) -> int:
    """Ranges the hashes of a band's sets are cut into: up to three elements each in the smallest of its sets."""
    return int(8 * BAND ** (band - 1) / 3) + 8


def bits_of(band: int) -> int:
    """Bits of a band's bitmaps: two or more for each element."""
    return 1 << max(6, int(np.ceil(np.log2(2 * 8 * BAND**band))))


def most_apart(size: int, other: int, percent: int) -> int:
    """Elements in one set only, at most, of two similar sets of these sizes."""
    return (100 - percent) * (size + other) // (100 + percent)


def spare_of(band: int, percent: int) -> int:
    """Tiles that a set of a band may leave."""
    least = int(8 * BAND ** (band - 1))
    return min(MOST_TILES // 2, most_apart(least, least, percent) // 2)


def tile_keys(own: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The tiles of a sorted set, and how many of those of its band may be left: of its own band, and of the next ones
    where it can be similar to a set of theirs. The lowest eight bits of a tile are its band."""
    largest = 100 * len(own) // percent
    apart = most_apart(len(own), largest, percent)
    tiles, spares = [np.empty(0, np.uint64)], [np.empty(0, np.int32)]
    if apart:  # else similar to equal sets only
        for band in range(band_of(len(own)), band_of(largest) + 1):
            # the upper half of the hash says which range; all of it goes into the key
            place = ((own >> np.uint64(32)) * np.uint64(ranges_of(band))) >> np.uint64(32)
            first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            keys = mixed(np.add.reduceat(mixed(own ^ np.uint64(0x5851F42D4C957F2D)), first) + place[first])
            spare = spare_of(band, percent)
            asked = min(apart + 1, MOST_TILES) + spare
            if len(keys) < asked:
                # it may agree with a set like it in empty ranges only: these meet in a tile of their own
                keys, spare = np.append(keys, np.uint64(0)), 0
            tiles.append((keys[:asked] if len(keys) > asked else keys) & ~np.uint64(255) | np.uint64(band))
            spares.append(np.full(len(tiles[-1]), spare, np.int32))
    return np.concatenate(tiles).view(np.int64), np.concatenate(spares)


def bitmap(own: np.ndarray, band: int) -> np.ndarray:
    """Each bit tells whether an odd number of elements falls on it: bitmaps differ in no more bits than sets in elements."""
    bits = bits_of(band)
    count = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8))


def sketched(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the set), tiles and bits (a bitmap for the set's own band)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, keys, tiles, spares, bits = [], [], [], [], []
            for own in shingle_sets(batch.column(1), size):
                count.append(len(own))
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).hexdigest() if len(own) else None)
                own_tiles, own_spares = tile_keys(own, percent)
                tiles.append(own_tiles)
                spares.append(own_spares)
                bits.append(bitmap(own, band_of(len(own))).tobytes())
            places = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in tiles])]).astype(np.int32))
            tile = pa.array(np.concatenate([*tiles, np.empty(0, np.int64)]))
            spare = pa.array(np.concatenate([*spares, np.empty(0, np.int32)]))
            lists = pa.ListArray.from_arrays(places, pa.StructArray.from_arrays([tile, spare], ["tile", "spare"]))
            columns = [batch.column(0), pa.array(count, pa.int64()), pa.array(keys, pa.string()), lists, pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_key", "tiles", "bits"])

    return docs.mapInArrow(sketch, "doc_id bigint, n_shingles bigint, set_key string, tiles array<struct<tile: bigint, spare: int>>, bits binary")


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (one a row) of the next band made as small as those of this one."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted sets."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sorted sets are similar."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = [
                similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                for x, y in zip(batch.column(2), batch.column(3))
            ]
            yield batch.select([0, 1]).filter(pa.array(close, pa.bool_()))

    rows = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    rows = rows.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    return rows.mapInArrow(check, "a bigint, b bigint")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [x.tobytes() for x in shingle_sets(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], ["doc_id", "shingles"])

    return docs.mapInArrow(sets, "doc_id bigint, shingles binary")


def _members(heads: DataFrame) -> DataFrame:
    """tile, doc_id, members: documents by the tiles that several share, without the tiles that a document may leave."""
    rows = heads.select("doc_id", F.inline("tiles"))
    shared = rows.groupBy("tile").agg(F.count("*").alias("members")).where("members > 1")
    order = W.partitionBy("doc_id", F.col("tile").bitwiseAND(255)).orderBy(F.desc("members"), "tile")
    ranked = rows.join(shared, "tile").withColumn("place", F.row_number().over(order))
    return ranked.where("place > spare").select("tile", "doc_id", "members")


def _star(members: DataFrame) -> DataFrame:
    """(a, b): every document with one other, the centre of a tile of it.

    The centre of a tile is its document with most partners over all tiles; a document takes the centre that has most.
    """
    partners = members.groupBy("doc_id").agg(F.sum(F.col("members") - 1).alias("partners"))
    known = members.select("tile", "doc_id").join(partners, "doc_id").select("tile", F.struct("partners", "doc_id").alias("rank"))
    centre = known.groupBy("tile").agg(F.max("rank").alias("centre"))
    best = known.join(centre, "tile").groupBy("rank.doc_id").agg(F.max("centre").alias("centre"))
    return best.select(F.col("doc_id").alias("b"), F.col("centre.doc_id").alias("a")).where("a <> b").select("a", "b")


def _apart(members: DataFrame, found: DataFrame, signs: DataFrame) -> DataFrame:
    """Members of tiles that hold several components, with their component, size and bitmap, dealt to sides."""
    node = found.select(F.col("node").alias("doc_id"), "component")
    rows = members.select("tile", "doc_id").join(node, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    several = rows.groupBy("tile").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rows = rows.join(several.where("low <> high").select("tile"), "tile").join(signs, "doc_id")
    held = rows.groupBy("tile").agg(F.count("*").alias("members"), F.sum(F.octet_length("bits")).alias("bytes"))
    sides = F.greatest(F.ceil(F.col("members") / SIDE_ROWS), F.ceil(F.col("bytes") / SIDE_BYTES)).alias("sides")
    rows = rows.join(held.select("tile", sides), "tile")
    return rows.withColumn("side", F.pmod(F.xxhash64("doc_id", "tile"), F.col("sides"))).drop("members", "bytes")


def _candidates(apart: DataFrame, percent: int, every: bool) -> DataFrame:
    """(a, b): pairs of a tile in different components that their sizes and bitmaps allow to be similar.

    Without `every`, pairs that others of the same tile imply, if those are similar, are left out. A tile is compared
    side by side: each task holds two sides of it.
    """

    def compare(tile: pa.Table) -> pa.Table:
        ids, groups, size, side = (tile.column(c).to_numpy().copy() for c in ("doc_id", "component", "n_shingles", "side"))
        raw = [np.frombuffer(x.as_buffer(), np.uint8) for c in tile.column("bits").chunks for x in c]
        width = min(map(len, raw))
        bits = np.concatenate([folded(x[None, :], width) for x in raw]).view(np.uint64)
        two = side.min() != side.max()
        a, b = [], []
        for k in np.flatnonzero(side == side.min()):
            other = np.flatnonzero(side != side[k]) if two else np.arange(k + 1, len(ids))
            other = other[groups[other] != groups[k]]
            other = other[100 * np.minimum(size[other], size[k]) >= percent * np.maximum(size[other], size[k])]
            differ = np.bitwise_count(bits[other] ^ bits[k]).sum(1, dtype=np.int64)
            # the sets differ in at least so many elements; that bounds the overlap from above
            overlap = (size[other] + size[k] - differ) // 2
            other = other[100 * overlap >= percent * (size[other] + size[k] - overlap)]
            for x in other:
                if every or groups[x] != groups[k]:
                    a.append(min(ids[k], ids[x]))
                    b.append(max(ids[k], ids[x]))
                    if not every:
                        groups[groups == groups[x]] = groups[k]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = apart.withColumn("meets", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("sides") - 1))).drop("sides")
    rows = rows.withColumns({"low": F.least("side", "meets"), "high": F.greatest("side", "meets")}).drop("meets")
    return rows.groupBy("tile", "low", "high").applyInArrow(compare, "a bigint, b bigint").distinct()


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id.

    Words are what stands between ASCII white space, with A-Z as a-z; a set holds the distinct shingles of `size`
    words, or all words as one shingle where there are fewer. Documents are linked when 100 * intersection >=
    `percent` * union; component_id is the smallest doc_id that links reach, itself included. Null and empty texts have
    no shingle and are linked with nothing. Rows that share a doc_id are one node; a null doc_id is linked with
    nothing. Other columns are not read.
    """
    own = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    rows = kept(sketched(own, size, percent), "sketches")
    named = rows.where("doc_id is not null and set_key is not null")
    classes = kept(named.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")), "set-classes")
    same = named.select("doc_id", "set_key").join(classes.where("first_id <> last_id"), "set_key").where("doc_id <> first_id")
    same = same.select(F.col("first_id").alias("a"), F.col("doc_id").alias("b"))

    heads = named.join(classes.select("set_key", F.col("first_id").alias("doc_id")), ["set_key", "doc_id"], "left_semi")
    heads = heads.select("doc_id", "set_key", "n_shingles", "tiles", "bits")
    members = kept(_members(heads.select("doc_id", "tiles")), "members")
    sharing = members.select("doc_id").distinct()
    sets = kept(_sets(own.join(sharing, "doc_id", "left_semi"), size), "sets")
    signs = heads.select("doc_id", "n_shingles", "bits")
    links = kept(same.unionByName(confirmed(_star(members), sets, percent)), "links")
    found = kept(components(links), "components")
    pairs = kept(_candidates(_apart(members, found, signs), percent, every=False), "candidates")
    if not pairs.isEmpty():
        links = links.unionByName(kept(confirmed(pairs, sets, percent), "links"))
        found = kept(components(links), "components")
        # what candidates implied that were not confirmed, or that two tasks joined without each other
        more = kept(confirmed(_candidates(_apart(members, found, signs), percent, every=True), sets, percent), "links")
        if not more.isEmpty():
            found = components(links.unionByName(more))
    out = rows.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
