"""SentencePiece encoding and decoding: Viterbi over a trie of the distinct marked words of a step.

Words are marked with the piece sign for space. The distinct words of some documents are sorted, which lays
them out as a trie visited depth-first: a word takes over the forward scores of the prefix it shares with the word
before, and only the rest is scored. Texts are encoded in steps of STEP characters; words found in earlier steps are
remembered up to a limit, so a task's memory depends neither on its rows nor on how many different words they hold.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm.common import steps
from rankweave.llm.lengths import TOKENIZERS

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
# Fixed value: the sign that stands for a space.
SPACE = "▁"
# A character of private use that goes before a text's own space signs.
ESCAPE = "\ue000"
# Characters of text that are encoded together; a longer document makes a step of its own.
STEP = 1 << 20
# Characters of words whose segmentation is remembered, and those a word counts for besides its own.
REMEMBERED = 1 << 20
WORD = 10
_WORD = re.compile(f"{SPACE}[^{SPACE}]*")
_ESCAPED = re.compile(f"{ESCAPE}(.)", re.DOTALL)


class Vocabulary(NamedTuple):
    """Pieces by identifier, their scores, and a trie of pieces read from their ends.

    A node of the trie has the score and identifier of what is read so far, None where that is no piece, and the
    nodes of the characters before it.
    """

    pieces: list[str]
    scores: dict[str, tuple[float, int]]
    ends: dict[str, tuple]
    by_byte: list[int]
    byte_of: dict[int, int]
    unknown: float


@lru_cache(maxsize=2)
def vocabulary(path: str = MODEL) -> Vocabulary:
    """Pieces with scores from a model file; control, unknown and byte pieces are no pieces of text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    by_byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    special = {i for i in range(len(pieces)) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
    scores = {p: (model.get_score(i), i) for i, p in enumerate(pieces) if i not in special}
    least = min((s for s, _ in scores.values()), default=0.0)
    before: dict[str, dict] = {"": {}}
    for tail in sorted({p[k:] for p in scores for k in range(len(p))}, key=len):
        before[tail] = {}
        before[tail[1:]][tail[0]] = (*scores.get(tail, (None, None)), before[tail])
    return Vocabulary(pieces, scores, before[""], by_byte, {i: b for b, i in enumerate(by_byte)}, least - 10.0)


def _marked(text: str) -> str:
    """The text with spaces as marks, after a first one. A mark of the text itself is escaped."""
    if SPACE in text or ESCAPE in text:
        text = text.replace(ESCAPE, ESCAPE + ESCAPE).replace(SPACE, ESCAPE + "s")
    return SPACE + text.replace(" ", SPACE)


def _plain(marked: str) -> str:
    text = marked[1:].replace(SPACE, " ")
    if ESCAPE in text:
        text = _ESCAPED.sub(lambda m: SPACE if m[1] == "s" else m[1], text)
    return text


def best_paths(words: list[str], vocab: Vocabulary) -> dict[str, list[int]]:
    """The segmentation of each word with the highest sum of scores; of equal ones the longest last piece wins.

    A character that is a piece of none is written as its bytes and scores below any piece. `words` are sorted here;
    forward scores are kept for the prefix shared with the word before.
    """
    ends, unknown = vocab.ends, vocab.unknown
    # for each number of characters the best score, and where its last piece begins and which one that is
    best, back, last, out, before = [0.0], [0], [None], {}, ""
    for word in sorted(words):
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1 :], back[shared + 1 :], last[shared + 1 :]
        for end in range(shared, len(word)):
            top, frm, piece = best[end] + unknown, end, None
            node = ends.get(word[end])
            if node is not None:
                score, own, further = node
                if own is not None:
                    top, piece = best[end] + score, own
                for start in range(end - 1, -1, -1):
                    node = further.get(word[start])
                    if node is None:  # no piece ends like this, so no longer one does
                        break
                    score, own, further = node
                    if own is not None and best[start] + score >= top:
                        top, frm, piece = best[start] + score, start, own
            best.append(top)
            back.append(frm)
            last.append(piece)
        ids, end = [], len(word)
        while end:
            if last[end] is None:
                ids += [vocab.by_byte[b] for b in reversed(word[end - 1].encode("utf-8", "surrogatepass"))]
            else:
                ids.append(last[end])
            end = back[end]
        ids.reverse()
        out[word] = ids
        before = word
    return out


class Paths:
    """Segmentations of words, remembered for later steps.

    Words of REMEMBERED characters are one generation, and the one before is still known: a word that keeps coming
    back stays, and a rare one is found again. The words of one step are always known together.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.recent, self.older, self.size = vocab, {}, {}, 0

    def of(self, words: Iterable[str]) -> dict[str, bytes]:
        """For the different `words`, and others, the identifiers as 32-bit integers."""
        if self.size >= REMEMBERED:
            self.recent, self.older, self.size = {}, self.recent, 0
        recent, older, new = self.recent, self.older, []
        for word in words:
            if word not in recent:
                if word in older:
                    recent[word] = older[word]
                else:
                    new.append(word)
                self.size += len(word) + WORD
        for word, ids in best_paths(new, self.vocab).items():
            recent[word] = array("i", ids).tobytes()
        return recent


def encode_step(texts: list[str | None], paths: Paths) -> list[np.ndarray | None]:
    """Piece identifiers of each text; null stays null and an empty text has none."""
    split = [_WORD.findall(_marked(x)) if x else [] for x in texts]
    known = paths.of(set().union(*split))
    return [None if x is None else np.frombuffer(b"".join([known[w] for w in some]), np.int32) for x, some in zip(texts, split)]


def encode_batch(column: pa.Array, paths: Paths) -> Iterator[tuple[list[str | None], list[np.ndarray | None]]]:
    """Texts of a string column, in steps, and the piece identifiers of each."""
    offsets = np.zeros(len(column) + 1, np.int64)
    np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), out=offsets[1:])
    for first, last in steps(offsets, STEP):
        texts = column.slice(first, last - first).to_pylist()
        yield texts, encode_step(texts, paths)


def decode_ids(ids, vocab: Vocabulary) -> str | None:
    """The text of piece identifiers: the exact inverse of `encode_step`."""
    if ids is None:
        return None
    pieces, byte_of = vocab.pieces, vocab.byte_of
    if byte_of.keys().isdisjoint(ids):
        return _plain("".join([pieces[i] for i in ids]))
    parts, some = [], bytearray()
    for i in ids:
        if i in byte_of:
            some.append(byte_of[i])
            continue
        if some:
            parts.append(some.decode("utf-8", "surrogatepass"))
            some = bytearray()
        parts.append(pieces[i])
    parts.append(some.decode("utf-8", "surrogatepass"))
    return _plain("".join(parts))


def _lists(ids: list[np.ndarray | None]) -> pa.Array:
    """Identifiers as a list column."""
    ends = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([0 if x is None else len(x) for x in ids], out=ends[1:])
    flat = np.concatenate([np.empty(0, np.int32), *[x for x in ids if x is not None]])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=pa.array([x is None for x in ids], pa.bool_()))


def encoded(text: str, model: str = MODEL) -> Column:
    """array<int> of piece identifiers of a text column."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        found = [_lists(ids) for _, ids in encode_batch(texts, Paths(vocabulary(model)))]
        return pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.int32()))

    return encode(F.col(text))


def decoded(ids: str, model: str = MODEL) -> Column:
    """Text of a column of piece identifiers."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        vocab = vocabulary(model)
        return pa.array([decode_ids(x, vocab) for x in rows.to_pylist()], pa.string())

    return decode(F.col(ids))


def sentence_pieces(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_pieces, pieces (identifiers), exact (decoding gives the text back).

    The score of a segmentation is the sum of its pieces' scores, the highest wins. Words end before a space, so
    pieces do not reach over one. Null texts have null pieces and n_pieces 0, empty ones have none; both are exact.
    """

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        paths = Paths(vocab)
        for batch in batches:
            done = 0
            for texts, ids in encode_batch(batch.column(1), paths):
                exact = [decode_ids(None if x is None else x.tolist(), vocab) == t for x, t in zip(ids, texts)]
                sizes = np.array([0 if x is None else len(x) for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(texts)), pa.array(sizes), _lists(ids), pa.array(exact)], ["doc_id", "n_pieces", "pieces", "exact"]
                )
                done += len(texts)

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(both, "doc_id bigint, n_pieces bigint, pieces array<int>, exact boolean")
