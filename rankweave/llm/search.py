"""Ranked lexical search over an index of length strata.

Documents with the same normaliser m form a stratum. What a term adds to a score depends on its weight, its number of
occurrences and m only, so inside a stratum it is computed once for each number of occurrences. The largest such
number of each term bounds what a stratum can score for an item: strata are visited from the largest bound down, and
an item passes over those that cannot reach its results any more. Large strata are stored in pieces.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankweave.llm.common import kept
from rankweave.storage import fits_broadcast

# Letters and digits of ASCII and every byte of other characters are in a term, A-Z as a-z.
_SPELLED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# Bytes of item texts that one pass over the documents serves.
ITEM_BYTES = 8 << 20
# Postings of one piece of a stratum, and entries of a matrix of scores.
PIECE_POSTINGS = 1 << 18
SCORES = 1 << 21
PIECE = "m bigint, doc_id array<bigint>, term array<int>, tf array<bigint>, place array<int>"


def terms_of(text: str | None) -> list[bytes]:
    """Terms in their order."""
    return text.encode().translate(_SPELLED).split() if text else []


def counted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (terms of the whole text), term (places in the vocabulary, ascending) and tf; no row for a text without terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            ids, sizes, found, times, starts = [], [], [], [], [0]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                own = sorted((place[t], c) for t, c in Counter(terms).items() if t in place)
                ids.append(doc)
                sizes.append(len(terms))
                found.extend(i for i, _ in own)
                times.extend(c for _, c in own)
                starts.append(len(found))
            at = pa.array(starts, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(found, pa.int32())), pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "term", "tf"])

    return docs.mapInArrow(count, "doc_id bigint, n bigint, term array<int>, tf array<bigint>")


def index(rows: DataFrame, documents: int, occurrences: int, slope: int = 75) -> DataFrame:
    """One row for each piece of a stratum: m, doc_id, and its postings by term and tf as term, tf and place (in doc_id).

    A stratum has as many pieces as its postings need; a document goes to one of them by a hash.
    """
    normal = F.expr(f"{100 - slope} + (({slope} * n * {documents}) div {max(occurrences, 1)})")
    held = rows.where(F.size("term") > 0).withColumn("m", normal)
    large = held.groupBy("m").agg(F.ceil(F.sum(F.size("term")) / PIECE_POSTINGS).alias("pieces")).where("pieces > 1")
    # documents of one stratum would all meet in a shuffled join; few strata are large
    large = F.broadcast(large) if fits_broadcast(large) else large
    piece = F.pmod(F.xxhash64("doc_id", "n", "term", "tf"), F.coalesce("pieces", F.lit(1)))
    dealt = held.join(large, "m", "left").withColumn("piece", piece).drop("n", "pieces")

    def build(piece: pa.Table) -> pa.Table:
        piece = piece.combine_chunks()
        terms, times = piece.column("term").combine_chunks(), piece.column("tf").combine_chunks()
        own = np.repeat(np.arange(len(piece)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
        term, tf = terms.flatten().to_numpy(), times.flatten().to_numpy()
        order = np.lexsort((own, tf, term))
        columns = [pa.array([x], kind) for x, kind in (
            (piece.column("doc_id").to_pylist(), pa.list_(pa.int64())), (term[order], pa.list_(pa.int32())),
            (tf[order], pa.list_(pa.int64())), (own[order], pa.list_(pa.int32())))]
        return pa.Table.from_arrays([piece.column("m").slice(0, 1), *columns], ["m", "doc_id", "term", "tf", "place"])

    return dealt.groupBy("m", "piece").applyInArrow(build, PIECE)


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    """What one unit of weight adds to a score."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Items:
    """The items of a pass by term: for term t the places `item[start[t]:start[t + 1]]`, with weight times repeats."""

    def __init__(self, texts: list[list[bytes]], vocabulary: list[bytes], weights: list[int]):
        place = {t: i for i, t in enumerate(vocabulary)}
        entries = sorted((place[t], i, c * weights[place[t]]) for i, own in enumerate(texts) for t, c in Counter(own).items())
        term, self.item, self.weight = (np.array([e[j] for e in entries], np.int64) for j in range(3))
        self.start = np.searchsorted(term, np.arange(len(vocabulary) + 1))
        self.count = len(texts)

    def spread(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each entry of `term` and each item with it: the entry, and the place in `item` and `weight`."""
        many = self.start[term + 1] - self.start[term]
        entry = np.repeat(np.arange(len(term)), many)
        first = np.repeat(self.start[term] - np.cumsum(many) + many, many)
        return entry, first + np.arange(len(entry))

    def bounds(self, m: int, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """What a stratum's documents score at most for each item; `tf` is the largest of each term."""
        entry, at = self.spread(term)
        out = np.zeros(self.count, np.int64)
        np.add.at(out, self.item[at], self.weight[at] * impact(tf, m)[entry])
        return out


def _largest(term: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different terms of postings sorted by term and tf, and the largest tf of each."""
    last = np.flatnonzero(np.append(term[1:] != term[:-1], True)) if len(term) else np.empty(0, np.int64)
    return term[last], tf[last]


def _bounded(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Index rows with `bound`: the largest of the items' bounds."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for batch in batches:
            out = []
            for i in range(len(batch)):
                term, tf = batch.column(2)[i].values.to_numpy(), batch.column(3)[i].values.to_numpy()
                out.append(int(items.bounds(batch.column(0)[i].as_py(), *_largest(term, tf)).max(initial=0)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*batch.schema.names, "bound"])

    return bound


def _visited(shared, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The k best documents of each item among the pieces of a task, which come by falling bound."""

    def best_of(score: np.ndarray, doc: np.ndarray, known: np.ndarray) -> np.ndarray:
        # without an identifier: behind all others of its score
        return np.lexsort((doc, ~known, -score))[:k]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
        best = [none] * items.count
        least = np.ones(items.count, np.int64)  # a document must score as much as this
        for batch in batches:
            for i in range(len(batch)):
                if batch.column(5)[i].as_py() < least.min(initial=1 << 62):
                    continue
                m = batch.column(0)[i].as_py()
                term, tf, place = (batch.column(j)[i].values.to_numpy() for j in (2, 3, 4))
                own = batch.column(1)[i].values
                doc, known = pc.fill_null(own, 0).to_numpy(), own.is_valid().to_numpy(zero_copy_only=False)
                asked = np.flatnonzero(items.bounds(m, *_largest(term, tf)) >= least)
                kinds, kind = np.unique(tf, return_inverse=True)
                worth = impact(kinds, m)[kind]
                entry, at = items.spread(term)
                step = max(1, SCORES // len(doc))
                for first in range(0, len(asked), step):
                    part = asked[first : first + step]
                    row = np.full(items.count, -1)
                    row[part] = np.arange(len(part))
                    mine = row[items.item[at]]
                    use = mine >= 0
                    score = np.zeros(len(part) * len(doc), np.int64)
                    np.add.at(score, mine[use] * len(doc) + place[entry[use]], items.weight[at[use]] * worth[entry[use]])
                    score = score.reshape(len(part), len(doc))
                    reach = score >= least[part, None]
                    for j in np.flatnonzero(reach.any(1)):
                        q, hit = part[j], np.flatnonzero(reach[j])
                        s, d, x = (np.concatenate(c) for c in zip(best[q], (score[j, hit], doc[hit], known[hit])))
                        top = best_of(s, d, x)
                        best[q] = (s[top], d[top], x[top])
                        if len(top) == k:
                            least[q] = max(1, s[top[-1]])
        place = [q for q, (s, _, _) in enumerate(best) for _ in s]
        score, doc, known = (np.concatenate([b[j] for b in best] or [none[j]]) for j in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(doc, mask=~known), pa.array(score)], ["item", "doc_id", "score"])

    return visit


def _passes(items: DataFrame) -> Iterator[list]:
    """Items in their order, in lists of at most ITEM_BYTES of text (or one item); one list at a time is on the driver."""
    sized = items.select("item_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).alias("bytes"))
    part, filled = [], 0
    for row in sized.orderBy(F.col("item_id").asc_nulls_last(), "text").toLocalIterator():
        if part and filled + row["bytes"] > ITEM_BYTES:
            yield part
            part, filled = [], 0
        part.append(row)
        filled += row["bytes"]
    if part:
        yield part


def _pass(spark: SparkSession, docs: DataFrame, items: list, k: int) -> DataFrame:
    texts = [terms_of(r["text"]) for r in items]
    vocabulary = sorted({t for own in texts for t in own})
    rows = kept(counted(docs, vocabulary), "terms")
    documents, occurrences = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # at most one row for each term of the items
    holding = dict(rows.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*")).collect())
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(i, 0) + 1))) for i in range(len(vocabulary))]
    shared = spark.sparkContext.broadcast(Items(texts, vocabulary, weights))
    pieces = kept(index(rows, documents, occurrences), "strata")
    ordered = pieces.mapInArrow(_bounded(shared), f"{PIECE}, bound bigint").where("bound > 0").sortWithinPartitions(F.desc("bound"))
    found = ordered.mapInArrow(_visited(shared, k), "item int, doc_id bigint, score bigint")
    order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(items)], "item int, item_id bigint")
    # one row for each item of the pass
    return kept(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest score above 0 for each item (item_id, text).

    Terms are runs of ASCII letters and digits and of other characters, A-Z as a-z; the whole text counts. Equal
    scores rank by ascending doc_id, null last. Null and empty texts have no term: as documents they are in no count
    and never found, as items they give no row. Each row of `docs` is a document, so repeated rows rank each; equal
    rows of `items` are one item, and different texts under one item_id are ranked each for itself. Other columns
    are not read. Items are served in passes of at most ITEM_BYTES of text, one after the other: the terms of a pass are
    broadcast, and each pass writes its own index of all documents over its terms.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    asked = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null").distinct()
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for part in _passes(asked):
        out = out.unionByName(_pass(spark, own, part, k))
    return out
