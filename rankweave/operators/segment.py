"""Dictionary segmentation for scripts written without spaces.

Texts are cut into pieces first: runs of letters and digits. Those with no character of the unspaced
script are words already. Only distinct pieces are segmented. Spark finds and spreads the pieces; the
Python part chooses a path through the dictionary words of one piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.functions.numeric import once
from rankweave.functions.text import digest

HAN = r"\p{IsHan}"
# Dictionary rows, and bytes of a trie of them at most, that may be sent to every executor; counted before it is done.
MOST_WORDS = 1_000_000
MOST_BYTES = 192 << 20
# Words up to this length are joined as they are, longer ones by their digest.
LONG = 32
# Log probabilities are whole millionths, so that sums are exact and equal paths are equal on every machine.
SCALE = 1_000_000
NO_WORD = -(1 << 62)
LIKELIEST = "likeliest"
LONGEST = "longest"


def pieces(df: DataFrame, text: str, keep: list[str] | None = None, script: str = HAN) -> DataFrame:
    """`(*keep, piece)`: runs of the script and other letters and digits."""
    runs = rf"([{script}\p{{L}}\p{{N}}]+)"  # one class: a repeated group overflows the stack on long runs
    return df.select(*(keep or []), F.explode(F.regexp_extract_all(text, F.lit(runs), 1)).alias("piece"))


def path_finder(unknown: float, method: str) -> Callable[..., list[str]]:
    """A function from one piece, the words found in it and its atoms to the words of the best path.

    The words found are `{start: [(length, log probability), …]}`. The atoms are the sizes of the parts of
    the piece, one for each character of the script and one for each run of others; without them every
    character is an atom. An atom that no word covers stands alone, with the log probability `unknown`; of
    one that a word covers in part, the rest does. A word without the script counts only as a whole run.
    The function is an inner one so that it travels to the Python workers by value; they need not have
    this package.
    """
    longest_first = method == LONGEST

    def by_character(piece: str, found: dict[int, list[tuple[int, float]]]) -> list[str]:
        size = len(piece)
        step, score = [1] * size, [0] * (size + 1)
        for start in range(size - 1, -1, -1):
            best, width = unknown + score[start + 1], 1
            for length, weight in found.get(start, ()):
                value = weight + score[start + length]
                if value > best or (value == best and length > width):
                    best, width = value, length
            score[start], step[start] = best, width
        words, start = [], 0
        while start < size:
            words.append(piece[start : start + step[start]])
            start += step[start]
        return words

    def find(piece: str, found: dict[int, list[tuple[int, float]]], atoms=None) -> list[str]:
        size = len(piece)
        if not longest_first and (atoms is None or len(atoms) == size):
            return by_character(piece, found)
        ends = list(range(1, size + 1))
        if atoms is not None and len(atoms) < size:
            at = 0
            for width in atoms:
                end = at + int(width)
                for start in range(at, end):
                    ends[start] = end
                    if end - at > 1 and start in found:
                        found[start] = [x for x in found[start] if start + x[0] > end or (start == at and x[0] == width)]
                # what no word covers reaches to the next place in the run where a word starts
                for start in range(end - 2, at - 1, -1):
                    ends[start] = start + 1 if found.get(start + 1) else ends[start + 1]
                at = end
        step = [end - start for start, end in enumerate(ends)]
        if longest_first:
            for start, options in found.items():
                if options:
                    step[start] = max(length for length, _ in options)
        else:
            whole = {}
            at = 0
            for width in atoms if atoms is not None and len(atoms) < size else ():
                whole |= {start: at + int(width) for start in range(at, at + int(width) - 1)}
                at += int(width)
            score = [0] * (size + 1)
            for start in range(size - 1, -1, -1):
                # up to each place of the run where a word starts, and to its end
                last = whole.get(start, start + 1)
                end = ends[start]
                best, width = unknown + score[end], end - start
                while end < last:
                    end = ends[end]
                    if (unknown + score[end], end - start) > (best, width):
                        best, width = unknown + score[end], end - start
                for length, weight in found.get(start, ()):
                    value = weight + score[start + length]
                    if (value, length) > (best, width):
                        best, width = value, length
                score[start], step[start] = best, width
        words, start = [], 0
        while start < size:
            words.append(piece[start : start + step[start]])
            start += step[start]
        return words

    return find


def segment(distinct: DataFrame, dictionary: DataFrame, method: str = LIKELIEST, script: str | None = None) -> DataFrame:
    """Add `words` to a table of distinct pieces, column `piece`.

    `dictionary` is `(word, freq)`. It is broadcast when counting shows that it is small enough;
    otherwise the words inside the pieces are found by a join, with the same result. With `script`, runs
    of other characters stay whole where no word covers them.
    """
    weights = dictionary.groupBy("word").agg(F.max("freq").cast("double").alias("freq"))
    # the total is of the counts as they are used: a word that was never counted counts once
    weights = weights.where("word <> ''").withColumn("freq", F.greatest(F.coalesce("freq", F.lit(1.0)), F.lit(1.0)))
    # no more beginnings than characters, of 16 bytes each, and the words that the trie is made of
    width = F.length("word").cast("double")
    size, total, most, lengths = weights.agg(
        F.count("word"),
        F.coalesce(F.sum("freq"), F.lit(1.0)),
        F.coalesce(F.sum(20 * width), F.lit(0.0)),
        F.array_sort(F.collect_set(F.length("word"))),
    ).first()
    unknown = round(-log(total) * SCALE)
    weights = weights.select("word", F.round((F.log("freq") - log(total)) * SCALE).cast("bigint").alias("weight"))
    # Cutting is heavy for its bytes: a fixed count, which runtime coalescing by size leaves alone. By
    # a hash of the piece, as a repartition by the piece itself is dropped after a grouping by it.
    spark = distinct.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    distinct = distinct.repartition(tasks, F.xxhash64("piece"))
    atoms = F.lit(None).cast("array<int>")
    if script is not None:
        parts = F.regexp_extract_all("piece", F.lit(rf"({script}|[^{script}]+)"), F.lit(1))
        # without two other characters side by side every character is a part
        atoms = F.when(F.col("piece").rlike(rf"[^{script}][^{script}]"), F.transform(parts, F.length))
    distinct = distinct.withColumn("_atoms", atoms)
    by_broadcast = size <= MOST_WORDS and most <= MOST_BYTES
    if by_broadcast:
        return _segment_by_broadcast(distinct, weights, unknown, method).drop("_atoms")
    return _segment_by_join(distinct, weights, lengths, unknown, method).drop("_atoms")


def _uncopied(udf):
    """Keep the optimizer from copying the call.

    Exploding its result adds a filter on it, and that filter, with a second call, would move below
    the counting of equal pieces.
    """
    return udf.asNondeterministic()


def trie(words: list[str], weights: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The beginnings of all words as a trie in two arrays: 16 bytes for each different beginning.

    Node n > 0 is the beginning that entry n - 1 of the first array leads to: its parent's number, times 2 ** 21, plus
    the code of its last character. Nodes are numbered by length first, so the array is sorted. The second array has
    a node's weight, or NO_WORD where only a longer word goes on.
    """
    codes = [np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) for word in words]
    sizes = np.array([len(x) for x in codes], np.int64)
    flat, starts = np.concatenate([*codes, np.empty(0, np.int64)]), np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    node, own, keys, of_node = np.zeros(len(words), np.int64), np.arange(len(words)), [], [np.array([NO_WORD])]
    weights, numbered, depth = np.array(weights, np.int64), 1, 0
    while True:
        own = own[sizes[own] > depth]
        if not len(own):
            return np.concatenate([*keys, np.empty(0, np.int64)]), np.concatenate(of_node)
        level, place = np.unique((node[own] << 21) + flat[starts[own] + depth], return_inverse=True)
        node[own] = numbered + place
        depth += 1
        weight = np.full(len(level), NO_WORD)
        whole = sizes[own] == depth
        weight[place[whole]] = weights[own[whole]]
        keys.append(level)
        of_node.append(weight)
        numbered += len(level)


def word_finder() -> Callable[[np.ndarray, np.ndarray, list[str]], Iterator[dict]]:
    """A function from a `trie` and pieces to the words in each, `{start: [(length, weight), ...]}`, shortest first.

    All places of all pieces go down the trie together, one character a step. An inner function, as `path_finder`.
    """
    import numpy as np

    no_word = NO_WORD

    def find(keys, weights, pieces: list[str]) -> Iterator[dict]:
        code = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in pieces])]).astype(np.int64)
        end = np.repeat(bounds[1:], np.diff(bounds))
        at, node, length = np.arange(len(code)), np.zeros(len(code), np.int64), 0
        starts, lengths, found = [], [], []
        while len(at) and len(keys):
            inside = at + length < end[at]
            at, node = at[inside], node[inside]
            key = (node << 21) + code[at + length]
            next_node = np.searchsorted(keys, key)
            hit = keys[np.minimum(next_node, len(keys) - 1)] == key
            at, node = at[hit], next_node[hit] + 1
            length += 1
            word = weights[node] != no_word
            starts.append(at[word])
            lengths.append(np.full(int(word.sum()), length))
            found.append(weights[node[word]])
        starts, lengths, found = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (starts, lengths, found))
        order = np.argsort(starts, kind="stable")
        starts, pairs = starts[order], list(zip(lengths[order].tolist(), found[order].tolist()))
        places, first = np.unique(starts, return_index=True)
        first = [*first.tolist(), len(pairs)]
        options = [pairs[i:j] for i, j in zip(first, first[1:])]
        piece = np.searchsorted(bounds, places, "right") - 1
        places = (places - bounds[piece]).tolist()
        parts = np.searchsorted(piece, np.arange(len(pieces) + 1)).tolist()
        for i, j in zip(parts, parts[1:]):
            yield dict(zip(places[i:j], options[i:j]))

    return find


def _segment_by_broadcast(distinct: DataFrame, weights: DataFrame, unknown: float, method: str) -> DataFrame:
    table = weights.toPandas()
    shared = distinct.sparkSession.sparkContext.broadcast(trie(table["word"].tolist(), table["weight"].tolist()))
    find, words_in = path_finder(unknown, method), word_finder()

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, atoms in batches:
            pieces = texts.tolist()
            yield pd.Series([find(*x) for x in zip(pieces, words_in(*shared.value, pieces), atoms)], dtype=object)

    return distinct.withColumn("words", _uncopied(cut)("piece", "_atoms"))


def _segment_by_join(
    distinct: DataFrame, weights: DataFrame, lengths: list[int], unknown: float, method: str, salts: int = 32
) -> DataFrame:
    """Every substring as long as some word is looked up; a common one is spread over salted keys.

    Rows of substrings carry a digest of their piece, as the piece itself, repeated for each of its
    characters, would be quadratic; long substrings are digests too. There are at most as many for each
    character as words have different lengths.
    """
    keyed = distinct.withColumn("_id", digest(F.col("piece")))
    characters = F.regexp_extract_all("piece", F.lit("(?s)."), F.lit(0))
    spelled = keyed.select("_id", "piece").distinct().select("_id", once(characters).alias("characters"))
    key = lambda word, length: F.when(length <= LONG, word).otherwise(digest(word))
    count = F.size("characters")
    known = F.array(*[F.lit(x) for x in lengths or [1]])

    def at(place):
        word = lambda length: F.array_join(F.slice("characters", place + 1, length), "")
        fit = F.filter(known, lambda length: place + length <= count)
        return F.transform(fit, lambda length: F.struct(place.alias("start"), length.alias("length"), key(word(length), length).alias("key")))

    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    spans = spelled.select("_id", F.inline(F.flatten(F.transform(places, at))))
    spans = spans.withColumn("salt", F.pmod(F.xxhash64("_id", "start"), F.lit(salts)).cast("int"))
    weights = weights.select(F.length("word").alias("length"), key(F.col("word"), F.length("word")).alias("key"), "weight")
    repeated = weights.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = (
        spans.join(repeated, ["length", "key", "salt"])
        .groupBy("_id")
        .agg(F.collect_list(F.struct("start", "length", "weight")).alias("found"))
    )
    find = path_finder(unknown, method)

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series, spans_found: pd.Series, parts: pd.Series) -> pd.Series:
        out = []
        for piece, spans, atoms in zip(texts, spans_found, parts):
            by_start: dict[int, list[tuple[int, float]]] = {}
            for span in spans if spans is not None else []:
                by_start.setdefault(span["start"], []).append((span["length"], span["weight"]))
            out.append(find(piece, by_start, atoms))
        return pd.Series(out, dtype=object)

    joined = keyed.join(found, "_id", "left")
    return joined.withColumn("words", _uncopied(cut)("piece", "found", "_atoms")).drop("_id", "found")


def dictionary_word_counts(
    df: DataFrame,
    text: str,
    dictionary: DataFrame,
    by: list[str] | None = None,
    min_length: int = 2,
    script: str = HAN,
    method: str = LIKELIEST,
) -> DataFrame:
    """`(*by, word, count)`. Pieces are counted before they are segmented, so each is cut once."""
    by = by or []
    times = pieces(df, text, by, script).groupBy(*by, "piece").agg(F.count(F.lit(1)).alias("times"))
    shortest = max(min_length, 1)
    kind = F.when(F.col("piece").rlike(script), "cut").when(F.length("piece") >= shortest, "word")
    # Generated after the counting, so that the two filters below stay above it and share its shuffle.
    counted = times.select("*", once(kind).alias("kind"))
    whole = counted.where("kind = 'word'").select(*by, F.col("piece").alias("word"), "times")
    # With `by`, a piece may be here once per group; it is then cut for each, which needs no join.
    cut = segment(counted.where("kind = 'cut'"), dictionary, method, script)
    parts = cut.select(*by, F.explode("words").alias("word"), "times").where(F.length("word") >= shortest)
    return whole.unionByName(parts).groupBy(*by, "word").agg(F.sum("times").alias("count"))
