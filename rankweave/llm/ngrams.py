"""Interpolated modified Kneser-Ney model over whole code points, kept as tables that grow with the text.

An n-gram is a string of ORDER code points, an order-k row its last k. Counts, discounts and probabilities are joins
and aggregations on these strings, sharded by their hash. Texts are scored in blocks: the different n-grams of a block
go to the model by shuffle, one row for each however often it occurs, and come back with their probability. The rows of
a block travel compressed, as the shuffle's own codec leaves texts over half as long again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.llm.common import kept

ORDER = 4
# Stands before the start of a text: a code point that no character has.
EDGE = 0x10FFFF
# Characters of a block, those a row counts for besides its text, those of one numpy step, and blocks that ask one row of the model.
BLOCK = 1 << 22
ROW = 64
STEP = 1 << 19
BLOCKS_A_SALT = 4096
# Level of compression of a block's rows.
LEVEL = 6


def grams(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different n-grams of some texts, for each character the number of its n-gram, and where each text begins."""
    parts = [np.frombuffer((x or "").encode("utf-32-le"), np.uint32) for x in texts]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(x) for x in parts], out=offsets[1:])
    if not offsets[-1]:
        return [], np.empty(0, np.int64), offsets
    own, alphabet = pd.factorize(np.concatenate(parts))
    alphabet, width = np.append(np.uint32(EDGE), alphabet), len(alphabet) + 1
    place = np.arange(len(own)) - np.repeat(offsets[:-1], np.diff(offsets))
    symbols = []  # before each character k - 1 back, last first; 0 is the edge
    for k in range(ORDER):
        back = np.zeros(len(own), np.int64)
        back[k:] = own[: len(own) - k] + 1
        back[place < k] = 0
        symbols.append(back)
    # the n-grams so far have numbers below the count of characters, so each step fits 64 bits
    number, spelled = symbols[-1], np.arange(width)[:, None]
    for back in symbols[-2::-1]:
        number, found = pd.factorize(number * width + back)
        spelled = np.hstack([spelled[found // width], (found % width)[:, None]])
    letters = alphabet[spelled].astype("<u4").tobytes().decode("utf-32-le")
    return [letters[k : k + ORDER] for k in range(0, len(letters), ORDER)], number, offsets


def _steps(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in lists of about STEP characters."""
    first, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= STEP:
            yield texts[first : k + 1]
            first, held = k + 1, 0
    if first < len(texts):
        yield texts[first:]


def _blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[int, pa.RecordBatch, bool]]:
    """(block, rows, whether it ends there): the rows of a task in reading order, `at` is the column of the text."""
    block, held = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        first = 0
        for k, text in enumerate(batch.column(at).to_pylist()):
            held += len(text or "") + ROW
            if held >= BLOCK:
                yield block, batch.slice(first, k + 1 - first), True
                block, first, held = block + 1, k + 1, 0
        if first < batch.num_rows:
            yield block, batch.slice(first), False


def _block_grams(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """block, gram, n: the n-grams of each block with their counts; `at` is the column of the text."""
    texts, block = [], 0

    def out():
        total = Counter()
        for some in _steps(texts):
            names, number, _ = grams(some)
            total.update(dict(zip(names, np.bincount(number, minlength=len(names)).tolist())))
        # in order, neighbours share their beginnings and take less on disk
        names = sorted(total)
        columns = [pa.array(np.full(len(names), block), pa.int64()), pa.array(names, pa.string()), pa.array([total[x] for x in names], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["block", "gram", "n"])

    for block, rows, ends in _blocks(batches, at):
        texts += rows.column(at).to_pylist()
        if ends:
            yield out()
            texts = []
    if texts:
        yield out()


def block_grams(texts: DataFrame, at: int = 0) -> DataFrame:
    """block, gram, n of a table whose column number `at` is a text."""
    return texts.mapInArrow(lambda batches: _block_grams(batches, at), "block bigint, gram string, n bigint")


def packed_blocks(rows: DataFrame, at: int = 0) -> DataFrame:
    """block, packed: the same blocks with all their columns, each stretch of rows as a compressed Arrow stream."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Arrow's own threads would stay in the worker, with memory of their own
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL), use_threads=False)
        for block, some, _ in _blocks(batches, at):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, some.schema, options=options) as stream:
                stream.write_batch(some)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary())], ["block", "packed"])

    return rows.mapInArrow(pack, "block bigint, packed binary")


def unpacked(packed: pa.ChunkedArray) -> pa.Table:
    """The rows of one block."""
    options = pa.ipc.IpcReadOptions(use_threads=False)
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer(), options=options).read_all() for x in packed])


def counts(texts: DataFrame) -> DataFrame:
    """gram, n over all texts of a one-column table."""
    return block_grams(texts).groupBy("gram").agg(F.sum("n").alias("n"))


def _tail(gram: str) -> Column:
    return F.expr(f"substring({gram}, 2)")


def kneser_ney(counted: DataFrame) -> dict[int, DataFrame]:
    """For each order its table gram, p (discounted share), and under -k the table context, rest (weight of the lower order).

    The highest order uses counts, lower ones the number of different symbols before an n-gram. Every order has three
    discounts from how many n-grams occur once to four times; an order too small for them takes 0.5, 1 and 1.5.
    """
    model, level = {}, counted.select("gram", F.col("n").cast("double").alias("n"))
    for k in range(ORDER, 0, -1):
        level = kept(level, f"grams-{k}")
        seen = {int(r["n"]): r["c"] for r in level.where("n <= 4").groupBy("n").agg(F.count("*").alias("c")).collect()}
        n1, n2, n3, n4 = (float(seen.get(i, 0)) for i in (1, 2, 3, 4))
        discount = [0.5, 1.0, 1.5]
        if n1 and n2 and n3 and n4:
            y = n1 / (n1 + 2 * n2)
            discount = [min(max(d, 0.05), i - 0.05) for i, d in enumerate((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3), 1)]
        cut = F.when(F.col("n") >= 3, discount[2]).when(F.col("n") >= 2, discount[1]).otherwise(discount[0])
        rows = level.withColumns({"context": F.substring("gram", 1, k - 1), "cut": cut})
        sums = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("passed"))
        model[-k] = kept(sums.select("context", "total", (F.col("passed") / F.col("total")).alias("rest")), f"rest-{k}")
        shares = rows.join(model[-k], "context")
        model[k] = shares.select("gram", ((F.col("n") - F.col("cut")) / F.col("total")).alias("p"))
        if k > 1:
            level = level.groupBy(_tail("gram").alias("gram")).agg(F.count("*").cast("double").alias("n"))
    return model


def probabilities(asked: DataFrame, model: dict[int, DataFrame]) -> DataFrame:
    """gram, nll for a one-column table of different n-grams: negative logarithms, zero-order is even over what was seen and one more.

    Goes up from single symbols: a k-gram meets the probability of its last k - 1 symbols. A key meets at most as many
    rows as there are different code points.
    """
    symbols = model[1].count() + 1
    levels = {ORDER: asked.select("gram")}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = levels[k + 1].select(_tail("gram").alias("gram")).distinct()
    lower = None
    for k in range(1, ORDER + 1):
        rows = levels[k].withColumns({"context": F.substring("gram", 1, k - 1), "tail": _tail("gram")})
        rows = rows.join(model[k], "gram", "left").join(model[-k].select("context", "rest"), "context", "left")
        if lower is None:
            rows = rows.withColumn("under", F.lit(1.0 / symbols))
        else:
            rows = rows.join(lower.select(F.col("gram").alias("tail"), F.col("q").alias("under")), "tail")
        q = F.coalesce("p", F.lit(0.0)) + F.coalesce("rest", F.lit(1.0)) * F.col("under")
        lower = rows.select("gram", q.alias("q"))
        if k < ORDER:
            lower = kept(lower, f"asked-{k}")
    return lower.select("gram", (-F.log("q")).alias("nll"))


def scored(docs: DataFrame, text: str, model: dict[int, DataFrame], carry: list[str]) -> DataFrame:
    """The columns `carry` of `docs` with symbols and nll: the characters of a text and the sum of their negative logarithms.

    Blocks follow from the order in which a task reads its rows. If a block comes out otherwise when it is read for
    the second time, the run fails; a table that was read from files does not.
    """
    own = docs.select(*[c for c in docs.columns if c in carry or c == text])
    at = own.columns.index(text)
    # the same columns both times, as a repartition orders rows by all that are read
    asked = kept(block_grams(own, at).select("block", "gram"), "asked", "zstd")
    salts = -(-asked.agg(F.count_distinct("block")).first()[0] // BLOCKS_A_SALT) or 1
    # a common n-gram is asked by every block, so its row of the model is there once for each salt
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)))
    known = kept(probabilities(asked.select("gram").distinct(), model), "probabilities")
    salted = asked.select("gram", "salt").distinct().join(known, "gram")
    answers = asked.join(salted, ["gram", "salt"]).select("block", "gram", "nll")
    shape = [f for f in own.schema.fields if f.name in carry]

    def score(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            raise ValueError("a block of texts was not there when read again")
        rows = unpacked(blocks.column("packed"))
        found = dict(zip(answers.column("gram").to_pylist(), answers.column("nll").to_pylist()))
        symbols, total = [np.empty(0, np.int64)], [np.empty(0)]
        for some in _steps(rows.column(at).to_pylist()):
            names, number, offsets = grams(some)
            try:
                nll = np.array([found[x] for x in names], float)
            except KeyError as missing:
                raise ValueError("a block of texts was not the same when read again") from missing
            sums = np.concatenate([[0.0], np.cumsum(nll[number])])
            symbols.append(np.diff(offsets))
            total.append(sums[offsets[1:]] - sums[offsets[:-1]])
        out = rows.select([f.name for f in shape])
        return out.append_column("symbols", pa.array(np.concatenate(symbols))).append_column("nll", pa.array(np.concatenate(total)))

    result = T.StructType([*shape, T.StructField("symbols", T.LongType()), T.StructField("nll", T.DoubleType())])
    return packed_blocks(own, at).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, result)
