"""Repeated passages: a Burrows-Wheeler transform with threshold-bounded interval expansion finds equal 100-byte strings.

Equal strings must meet, so every 100-byte string is routed by its smallest-hash run of 20 bytes. Neighbouring strings
mostly share that run and travel as one segment of 100 to 180 bytes. The segments of one route are the text of one
transform; there, backward extension in rounds of increasing length finds where the common prefix of neighbouring
suffixes ends, and stops at 100: suffixes that no boundary separates start the same 100-byte string, and all but
the first in document order are removed. Segments whose anchor no other one has with the same 40 bytes before or after it
share no such string and are left out of the transform.

A run that many different segments share (a common phrase) would bring them all to one task. Such hot runs are found by
a count over all texts and rank after all others: a string that holds one is routed by its surroundings, and equal
strings still agree on their run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.common import mixed, steps, utf8

LENGTH = 100
ANCHOR = 20
# Bytes of text whose segments are packed together, bytes of segments on one route, bytes in one transform.
PACK_BYTES = 16 << 20
ROUTE_BYTES = 24 << 20
BLOCK_BYTES = 3 << 20
# Different segments that make a run hot; segments of a run that a task of the count must see to report it.
HOT_SEGMENTS = 20_000
LEAST_REPORTED = 8
# Hot runs there can be at most, by the number of segments that each needs: 8 MB as a sorted array.
HOT_RUNS = 1 << 20
# Bytes of text whose runs are hashed at a time: their arrays stay in a core's cache.
_HASHED_BYTES = 1 << 16
# Bytes of segments for one byte of text, about.
_GROWTH = 3.4
_PLACE_BITS = np.uint64(34)
_PLACE = np.uint64((1 << 34) - 1)
_FACTOR = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(2).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_FACTOR, k, 1 << 64))


def _longer(x: np.ndarray, size: int, y: np.ndarray, more: int) -> np.ndarray:
    """Hashes of all runs of size + more bytes from those of `size` (x) and `more` (y) bytes."""
    count = len(y) - size
    return x[:count] * _power(more) + y[size : size + count]


def _run_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ANCHOR bytes and of LENGTH bytes, from hashes of 1, 2, 4 ... bytes."""
    one = _BYTE[data]
    h = {1: one}
    for k in (1, 2, 4, 8, 16, 32):
        h[2 * k] = _longer(h[k], k, h[k], k)
    return _longer(h[16], 16, h[4], 4), _longer(_longer(h[64], 64, h[32], 32), 96, h[4], 4)


def _least_places(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` neighbours."""
    size = 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[: len(keys) - (width - size)], keys[width - size :]) if size < width else keys


class Segments(NamedTuple):
    """Segments of some documents: document, first byte in it, bytes, anchor and its hash, digests, and the bytes' place."""

    doc: np.ndarray
    start: np.ndarray
    size: np.ndarray
    anchor: np.ndarray
    route: np.ndarray
    head: np.ndarray
    tail: np.ndarray
    place: np.ndarray


def _among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array that is not empty."""
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values


def segments(data: np.ndarray, offsets: np.ndarray, hot: np.ndarray | None = None) -> Segments:
    """All segments: maximal runs of 100-byte strings of a document that have their anchor at the same place.

    The routes in the sorted array `hot` become the anchor of a string only where it holds no other run.
    """
    empty = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return Segments(empty, empty, empty, empty, *[np.empty(0, np.uint64)] * 3, empty)
    anchors, wholes = _run_hashes(data)
    keys = (mixed(anchors) >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(anchors), dtype=np.uint64)
    if hot is not None and len(hot):
        after = _among(mixed(anchors + np.uint64(1)), hot).astype(np.uint64) << np.uint64(63)
        keys = ((keys >> _PLACE_BITS >> np.uint64(1) << _PLACE_BITS) | (keys & _PLACE)) | after
    least = _least_places(keys, LENGTH - ANCHOR + 1) & _PLACE
    inside = np.zeros(len(least) + 1, np.int32)
    long = np.flatnonzero(np.diff(offsets) >= LENGTH)
    inside[offsets[long]] += 1
    inside[offsets[long + 1] - LENGTH + 1] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int32) > 0
    # a new run begins where a document begins and where the anchor moves
    begins = np.empty(len(least), bool)
    begins[0] = True
    np.not_equal(least[1:], least[:-1], out=begins[1:])
    begins[offsets[long]] = True
    begins &= inside
    first = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= begins[1:] | ~inside[1:]
    last = np.flatnonzero(ends)
    doc = np.searchsorted(offsets, first, "right") - 1
    anchor = least[first].astype(np.int64)
    return Segments(doc, first - offsets[doc], last - first + LENGTH, anchor - first, mixed(anchors[anchor] + np.uint64(1)), wholes[first], wholes[last], first)


def _gather(data: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of many ranges, one after the other."""
    view = memoryview(data)
    return np.frombuffer(b"".join([view[a:b] for a, b in zip(place.tolist(), (place + size).tolist())]), np.uint8)


def _packed(docs: np.ndarray, keys: np.ndarray, data: np.ndarray, s: Segments, routes: int) -> Iterator[tuple[int, bytes]]:
    """(route, block) for all segments of one pack. Of segments that are equal here, later ones travel without bytes."""
    # order of documents and places, then the first of each group of equal segments
    order = np.lexsort((s.start, keys[s.doc], docs[s.doc]))
    same = order[np.lexsort((s.tail[order], s.head[order], s.size[order]))]
    again = np.zeros(len(same), bool)
    again[1:] = (s.size[same[1:]] == s.size[same[:-1]]) & (s.head[same[1:]] == s.head[same[:-1]]) & (s.tail[same[1:]] == s.tail[same[:-1]])
    later = np.zeros(len(same), bool)
    later[same] = again
    # within a route by document and place, so that numbers shrink to small steps
    part = (s.route % np.uint64(routes)).astype(np.int64)
    by_part = order[np.argsort(part[order], kind="stable")]
    edges = np.flatnonzero(np.diff(part[by_part], prepend=-1))
    squeeze = zstandard.ZstdCompressor(level=3)
    for begin, end in zip(edges, np.append(edges[1:], len(by_part))):
        own = by_part[begin:end]
        new = np.diff(s.doc[own], prepend=-1) != 0
        used, fresh = s.doc[own[new]], own[~later[own]]
        fields = [
            np.array([len(used), len(own)], np.int64), np.diff(docs[used], prepend=np.int64(0)), keys[used], new, s.start[own] & 0xFFFFFFFF,
            s.start[own] >> 32, s.size[own], s.anchor[own], later[own], _gather(data, s.place[fresh], s.size[fresh]),
        ]
        yield int(part[own[0]]), squeeze.compress(b"".join(x.astype(kind).tobytes() for x, kind in zip(fields, _FIELDS)))


# How the fields of a block are written; identifiers are steps from one document to the next.
_FIELDS = [np.int64, np.int64, np.int32, np.uint8, np.uint32, np.uint32, np.uint8, np.uint8, np.uint8, np.uint8]


def _unpacked(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray], np.ndarray]:
    """Documents, their keys, fields of all segments (place: where its bytes begin, if it has any), and all bytes."""
    names = ("doc", "low", "high", "size", "anchor", "later")
    docs, keys, bytes_, fields, known = [], [], [], {k: [] for k in names}, 0
    for block in blocks:
        raw = zstandard.ZstdDecompressor().decompress(block)
        n, m = (int(x) for x in np.frombuffer(raw, np.int64, 2))
        docs.append(np.cumsum(np.frombuffer(raw, np.int64, n, 16)))
        keys.append(np.frombuffer(raw, np.int32, n, 16 + 8 * n))
        at = 16 + 12 * n
        for name, kind in zip(names, _FIELDS[3:9]):
            values = np.frombuffer(raw, kind, m, at)
            at += values.nbytes
            fields[name].append(np.cumsum(values, dtype=np.int64) - 1 + known if name == "doc" else values)
        bytes_.append(np.frombuffer(raw, np.uint8, offset=at))
        known += n
    out = {k: np.concatenate(v) for k, v in fields.items()}
    out["start"] = out.pop("low").astype(np.int64) | out.pop("high").astype(np.int64) << 32
    out["size"] = out["size"].astype(np.int64)
    size = np.where(out["later"] == 0, out["size"], 0)
    out["place"] = np.cumsum(size) - size
    return np.concatenate(docs), np.concatenate(keys), out, np.concatenate(bytes_)


def _hashes(data: np.ndarray, place: np.ndarray, size: int = ANCHOR) -> np.ndarray:
    """Hashes of the runs of `size` bytes at some places."""
    total = np.zeros(len(place), np.uint64)
    for k in range(size):
        total = total * np.uint64(_FACTOR) + _BYTE[data[place + k]]
    return total


def _equal_to_earlier(data: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each range of bytes whether one before it in the list is equal, by length and two 64-bit hashes."""
    if not len(place):
        return np.empty(0, bool)
    begin = np.cumsum(size) - size
    inside = np.arange(int(size.sum())) - np.repeat(begin, size)
    value = _BYTE[_gather(data, place, size)]
    table = np.arange(1, int(size.max()) + 1, dtype=np.uint64) * np.uint64(_FACTOR)
    a, b = (np.add.reduceat(value * (mixed(table + np.uint64(k)) | np.uint64(1))[inside], begin) for k in (3, 5))
    same = np.lexsort((b, a, size))
    out = np.zeros(len(place), bool)
    x, y = same[1:], same[:-1]
    out[x] = (size[x] == size[y]) & (a[x] == a[y]) & (b[x] == b[y])
    return out


def _share_half(data: np.ndarray, place: np.ndarray, size: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Which of some different segments have the bytes from their anchor on, or those up to its end, like another one.

    Equal strings hold their anchor at the same place, so of the LENGTH - ANCHOR bytes around it half or more are on one
    side: segments that share a string share the anchor with that half. The others need no transform.
    """
    out, half = np.zeros(len(place), bool), (LENGTH - ANCHOR + 1) // 2
    for first in (anchor - half, anchor):
        whole = np.flatnonzero((first >= 0) & (first + half + ANCHOR <= size))
        _, number, often = np.unique(_hashes(data, (place + first)[whole], half + ANCHOR), return_inverse=True, return_counts=True)
        out[whole] |= often[number] > 1
    return out


def suffix_order(text: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Places of all suffixes, sorted by their first `length` (64 to 128) bytes; past the end stand zeros."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + n]
    order = np.argsort(key)
    rank = np.empty(n + length, np.int64)
    rank[n:] = -1
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = key[order][1:] != key[order][:-1]
    # the rank of a suffix is the row at which its group begins, so settled ones keep theirs
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    for step in (8, 16, 32, length - 64):
        alone = new.copy()
        alone[:-1] &= new[1:]
        open_rows = np.flatnonzero(~alone)
        if not len(open_rows):
            break
        place = order[open_rows]
        both = rank[place] * np.int64(n + 1) + rank[place + step] + 1
        inner = np.argsort(both)
        order[open_rows] = place[inner]
        both = both[inner]
        differs = np.empty(len(both), bool)
        differs[0] = True
        differs[1:] = both[1:] != both[:-1]
        new[open_rows] |= differs
        rank[order[open_rows]] = np.maximum.accumulate(np.where(differs, open_rows, 0))
    return order


def prefix_bounds(text: np.ndarray, order: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each row whether its suffix has fewer than `length` bytes in common with the row before.

    Breadth-first backward extension on the transform: the interval of a string w, extended by a byte c before it,
    becomes that of cw, and the row after it ends a common prefix of len(w). Rounds go by increasing length and stop
    at `length`; an interval is extended only if its end was not known before. The rounds start with the intervals
    of all strings of 8 bytes.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    bound = np.zeros(n + 1, bool)
    bound[[0, n]] = True
    for k in range(8):
        byte = padded[order + k]
        bound[1:n] |= byte[1:] != byte[:-1]
    bwt = text[order - 1]  # the first suffix is preceded by the last byte, a separator
    by_byte = np.argsort(bwt, kind="stable")
    back = np.empty(n, np.int64)
    back[by_byte] = np.arange(n)
    low = np.flatnonzero(bound)
    low, high = low[:-1], low[1:]  # intervals low <= row < high
    for _ in range(8, length):
        size = high - low
        one = size == 1
        single = back[low[one]]
        ends, begins = [single + 1], [single]
        if not one.all():
            low, size = low[~one], size[~one]
            rows = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            own = np.repeat(np.arange(len(low)), size)
            to = back[rows]
            turn = np.argsort(to)
            to, own, byte = to[turn], own[turn], bwt[rows[turn]]
            first = np.ones(len(to), bool)
            first[1:] = (own[1:] != own[:-1]) | (byte[1:] != byte[:-1])
            last = np.ones(len(to), bool)
            last[:-1] = first[1:]
            begins.append(to[first])
            ends.append(to[last] + 1)
        low, high = np.concatenate(begins), np.concatenate(ends)
        fresh = ~bound[high]
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
        bound[high] = True
    return bound[:n]


def _later_windows(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Places whose string of LENGTH bytes also starts at a smaller place; `left` is how many bytes of its segment a place has."""
    order = suffix_order(text)
    bound = prefix_bounds(text, order)
    group = np.cumsum(bound) - 1
    starts = left[order] >= LENGTH
    first = np.full(int(group[-1]) + 1, len(text), np.int64)
    np.minimum.at(first, group[starts], order[starts])
    place = order[starts]
    return np.sort(place[place > first[group[starts]]])


def _removed_runs(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents, their keys, and runs to remove: document number, first byte, end."""
    docs, keys, f, data = _unpacked(blocks)
    later = f["later"] > 0
    runs = [(f["doc"][later], f["start"][later], f["start"][later] + f["size"][later])]
    # an anchor that occurs once repeats nothing
    own = np.flatnonzero(~later)
    _, number, often = np.unique(_hashes(data, f["place"][own] + f["anchor"][own]), return_inverse=True, return_counts=True)
    repeated = often[number] > 1
    own, number = own[repeated], number[repeated]
    order = np.lexsort((f["start"][own], keys[f["doc"][own]], docs[f["doc"][own]]))
    own, number = own[order], number[order]
    # of equal segments the first one is part of the text, the others repeat all of it
    again = _equal_to_earlier(data, f["place"][own], f["size"][own])
    r = own[again]
    runs.append((f["doc"][r], f["start"][r], f["start"][r] + f["size"][r]))
    own, number = own[~again], number[~again]
    shares = _share_half(data, f["place"][own], f["size"][own], f["anchor"][own].astype(np.int64))
    own, number = own[shares], number[shares]
    # segments of one anchor stay together in a block, in document order
    order = np.argsort(number, kind="stable")
    own, number = own[order], number[order]
    size = f["size"][own]
    edges = np.flatnonzero(np.diff(number, prepend=-1))
    filled = np.cumsum(size)
    begin = 0
    while begin < len(own):
        before = filled[begin - 1] if begin else 0
        k = np.searchsorted(edges, np.searchsorted(filled, before + BLOCK_BYTES, "right"), "right") - 1
        end = int(edges[k]) if edges[k] > begin else int(edges[k + 1]) if k + 1 < len(edges) else len(own)
        if filled[-1] - before <= BLOCK_BYTES:
            end = len(own)
        part, width = own[begin:end], size[begin:end]
        text = np.zeros(int(width.sum()) + len(part), np.uint8)
        at = np.cumsum(width + 1) - width - 1
        inside = np.repeat(at - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        text[inside] = _gather(data, f["place"][part], width)
        text[inside[text[inside] == 0]] = 0xFF  # a byte that no text in UTF-8 has; 0 separates segments
        left = np.zeros(len(text), np.int64)
        left[inside] = np.repeat(at + width, width) - inside
        place = _later_windows(text, left)
        if len(place):
            segment = np.searchsorted(at, place, "right") - 1
            offset = f["start"][part][segment] + place - at[segment]
            new = np.ones(len(place), bool)
            new[1:] = (segment[1:] != segment[:-1]) | (np.diff(place) > LENGTH)
            last = np.append(np.flatnonzero(new)[1:] - 1, len(place) - 1)
            runs.append((f["doc"][part][segment[new]], offset[new], offset[last] + LENGTH))
        begin = end
    return docs, keys, *[np.concatenate(x).astype(np.int64) for x in zip(*runs)]


def _shared_routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """route and n: routes that at least LEAST_REPORTED segments of the task have, equal ones of one pack counted once."""

    def summed(routes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        each, number = np.unique(np.concatenate(routes), return_inverse=True)
        return each, np.bincount(number, np.concatenate(counts), len(each)).astype(np.int64)

    total, parts, held = (np.empty(0, np.uint64), np.empty(0, np.int64)), [], 0

    def counted():
        route, head, tail, size = (np.concatenate([getattr(s, k) for s in parts]) for k in ("route", "head", "tail", "size"))
        order = np.lexsort((tail, head, size, route))
        route, head, tail, size = route[order], head[order], tail[order], size[order]
        new = np.ones(len(route), bool)
        new[1:] = (route[1:] != route[:-1]) | (head[1:] != head[:-1]) | (tail[1:] != tail[:-1]) | (size[1:] != size[:-1])
        each, n = np.unique(route[new], return_counts=True)
        return summed([total[0], each[n > 1]], [total[1], n[n > 1]])

    for batch in batches:
        body, offsets = utf8(batch.column(0))
        for first, last in steps(offsets, _HASHED_BYTES):
            s = segments(body[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            parts.append(s)
            held += int(offsets[last] - offsets[first])
            if held >= PACK_BYTES:
                total, parts, held = counted(), [], 0
    if parts:
        total = counted()
    often = total[1] >= LEAST_REPORTED
    yield pa.RecordBatch.from_arrays([pa.array(total[0][often].view(np.int64)), pa.array(total[1][often])], ["route", "n"])


def hot_routes(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted routes that HOT_SEGMENTS different segments have, more where `size` bytes of text could hold over HOT_RUNS of them.

    What is not found only stays together: results do not depend on it.
    """
    least = max(HOT_SEGMENTS, math.ceil(size * _GROWTH / LENGTH / HOT_RUNS))
    shared = docs.select("text").mapInArrow(_shared_routes, "route bigint, n bigint")
    hot = shared.groupBy("route").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("route").toArrow()
    return np.sort(hot.column("route").to_numpy().astype(np.int64).view(np.uint64))


def _routed(routes: int, hot: np.ndarray | None = None):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(docs, keys, data, parts):
            if not parts:
                return
            merged = Segments(*[np.concatenate(x) for x in zip(*parts)])
            some, size = [], 0
            for row in _packed(np.concatenate(docs), np.concatenate(keys), np.concatenate(data), merged, routes):
                some.append(row)
                size += len(row[1])
                if size > 4 << 20:
                    yield batch_of(some)
                    some, size = [], 0
            if some:
                yield batch_of(some)

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], ["route", "block"])

        docs, keys, data, parts, held, known = [], [], [], [], 0, 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            marks = batch.column(1).to_numpy(zero_copy_only=False)
            body, offsets = utf8(batch.column(2))
            for first, last in steps(offsets, _HASHED_BYTES):
                own = body[offsets[first] : offsets[last]]
                s = segments(own, offsets[first : last + 1] - offsets[first], hot)
                if len(s.doc):
                    docs.append(ids[first:last])
                    keys.append(marks[first:last])
                    data.append(own.copy())
                    parts.append(s._replace(doc=s.doc + known, place=s.place + held))
                    held += len(own)
                    known += last - first
                if held >= PACK_BYTES:
                    yield from out(docs, keys, data, parts)
                    docs, keys, data, parts, held, known = [], [], [], [], 0, 0
        yield from out(docs, keys, data, parts)

    return route


def _runs_of_route(table: pa.Table) -> pa.Table:
    docs, keys, doc, start, end = _removed_runs(table.column("block").to_pylist())
    order = np.argsort(doc, kind="stable")
    doc, start, end = doc[order], start[order], end[order]
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    places = pa.array(np.append(first, len(doc)), pa.int32())
    lists = [pa.ListArray.from_arrays(places, pa.array(x, pa.int64())) for x in (start, end)]
    return pa.table({"id": pa.array(docs[doc[first]]), "mark": pa.array(keys[doc[first]]), "starts": lists[0], "ends": lists[1]})


def _merged_runs(starts, ends) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs from lists of runs; runs that touch are one."""
    if starts is None or not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, end = np.concatenate(list(starts)).astype(np.int64), np.concatenate(list(ends)).astype(np.int64)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)]


CUT = "n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"


def _cut(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    out = []
    for body, s, e in zip(text, starts, ends):
        data = (body or "").encode()
        begin, end = _merged_runs(s, e)
        parts, at = [], 0
        for b, x in zip(begin.tolist(), end.tolist()):
            parts.append(data[at:b])
            at = x
        parts.append(data[at:])
        spans = [{"start": b, "end": x} for b, x in zip(begin.tolist(), end.tolist())]
        out.append((len(data), int((end - begin).sum()), spans, b"".join(parts)))
    return pd.DataFrame(out, columns=["n_bytes", "n_removed", "spans", "kept"])


# A null identifier comes before all others.
_NO_ID = -(1 << 63)


def repeated_runs(docs: DataFrame) -> DataFrame:
    """id, mark, starts, ends (lists of lists): bytes of each text covered by a string of LENGTH bytes that starts earlier too."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    routes = max(1, math.ceil(size * _GROWTH / ROUTE_BYTES))
    # a table that holds fewer segments than a route does not need the count
    hot = hot_routes(docs, size) if routes > 1 else None
    blocks = docs.select("id", "mark", "text").mapInArrow(_routed(routes, hot), "route int, block binary")
    runs = blocks.groupBy("route").applyInArrow(_runs_of_route, "id bigint, mark int, starts array<bigint>, ends array<bigint>")
    return runs.groupBy("id", "mark").agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"))


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, n_bytes, n_removed, spans (start and end of removed runs), kept (bytes).

    Texts are UTF-8 bytes, null is empty, matches never cross texts. Every byte covered by a string of LENGTH bytes
    that also starts earlier (smaller doc_id, or earlier in the same text) goes, judged on the input; runs that touch
    are one. A null doc_id comes before all others. Rows that share a doc_id are ordered by a hash of their text; rows
    that share both are one document given twice.
    """
    own = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).withColumns({"id": F.coalesce("doc_id", F.lit(_NO_ID)), "mark": F.hash("text")})
    runs = repeated_runs(own).withColumnsRenamed({"id": "run_id", "mark": "run_mark"})
    cut = own.join(runs, (own["id"] == runs["run_id"]) & (own["mark"] == runs["run_mark"]), "left")
    return cut.select("doc_id", F.pandas_udf(_cut, CUT)("text", "starts", "ends").alias("cut")).select("doc_id", "cut.*")
