"""Set join, centroid clustering and ranked search against brute force, and on odd rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from test_corpus import ODD, SCHEMA, documents, prose

from conftest import plan
from rankweave.llm import centroids, search, tiles

# set join


def shingle_set(text, size):
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    return {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))} if own else set()


def linked(texts, size, percent):
    """Brute force: n_shingles and the smallest identifier that links reach, for each row."""
    sets = [(i, shingle_set(t, size)) for i, t in texts]
    root = {i: i for i, _ in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and None not in (i, j) and 100 * len(x & y) >= percent * len(x | y):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted((i, len(x), find(i)) for i, x in sets)


def changed(pick, text, share):
    return " ".join(w if pick.random() > share else "".join(pick.choices("klmnop", k=5)) for w in text.split())


@pytest.mark.parametrize("size, percent", [(4, 85), (2, 80), (1, 60)])
def test_join_matches_brute_force(spark, size, percent):
    pick = random.Random(size)
    bases = [" ".join(t.split() * 1) for t in prose(31, 8, 30) + prose(32, 6, 160) + [" ".join(prose(33, 40))]]
    texts = [changed(pick, b, pick.choice([0, 0.004, 0.01, 0.03, 0.06, 0.2])) for b in bases for _ in range(14)] + prose(34, 60, 6)
    shared = " ".join(prose(35, 3, 60))
    texts += [f"{t} {shared}" for t in prose(36, 30, 90)]
    texts = list(enumerate(pick.sample(texts, len(texts))))
    out = tiles.similar_documents(documents(spark, texts), size, percent)
    assert sorted(tuple(r) for r in out.collect()) == linked(texts, size, percent)


def test_similar_sets_share_a_tile_neither_leaves():
    """Over sizes: sets as far apart as the limit allows, whatever the other tiles' popularity."""
    random_numbers = np.random.default_rng(5)
    for n in [*range(6, 60), 90, 135, 136, 300, 900, 5000]:
        base = random_numbers.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2)
        for gone in range(n // 3 + 1):
            for added in {0, gone, max(0, gone - 1)}:
                x, y = base[:n], np.concatenate([base[gone:n], base[n : n + added]])
                if 100 * (n - gone) < 85 * (n + added):
                    continue
                (a, left_a), (b, left_b) = (tiles.tile_keys(np.sort(s), 85) for s in (x, y))
                for band in set(a & 255) & set(b & 255):
                    own, other = a[(a & 255) == band], b[(b & 255) == band]
                    spare = max(left_a[(a & 255) == band].max(), left_b[(b & 255) == band].max())
                    enough = len(np.intersect1d(own, other)) > spare
                    if enough:
                        break
                else:
                    assert not gone and not added, (n, gone, added)
    few = tiles.tile_keys(np.sort(random_numbers.integers(0, 1 << 63, 5, dtype=np.uint64)), 85)[0]
    assert not len(few)


def test_bitmaps_bound_the_difference():
    random_numbers = np.random.default_rng(6)
    for n, m in [(10, 12), (300, 320), (2000, 1900)]:
        base = random_numbers.integers(0, 1 << 63, n + m, dtype=np.uint64)
        x, y = base[:n], base[n // 3 : n // 3 + m]
        own, other = tiles.bitmap(x, tiles.band_of(n)), tiles.bitmap(y, tiles.band_of(m))
        width = min(len(own), len(other))
        differ = tiles.folded(own[None, :], width) ^ tiles.folded(other[None, :], width)
        assert int(np.bitwise_count(differ).sum()) <= len(np.setxor1d(x, y))


def test_join_in_small_sides(spark, monkeypatch):
    monkeypatch.setattr(tiles, "SIDE_ROWS", 3)
    pick = random.Random(9)
    # neighbours of a chain are linked, its ends are not
    words = prose(37, 1, 400)[0].split() * 3
    texts = [(i, " ".join(words[4 * i : 4 * i + 120])) for i in range(40)]
    pick.shuffle(texts)
    out = tiles.similar_documents(documents(spark, texts), 2, 80)
    assert sorted(tuple(r) for r in out.collect()) == linked(texts, 2, 80)


def test_join_of_odd_rows(spark):
    out = tiles.similar_documents(documents(spark, [*ODD, (7, "X"), (8, "x")]), 4, 85)
    found = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect())
    assert found == {
        (None, 0, None): 1, (None, 1, None): 1, (1, 0, 1): 1, (2, 0, 2): 1, (3, 0, 3): 1, (4, 1, 4): 1, (5, 1, 5): 3, (6, 1, 6): 1, (7, 1, 5): 1, (8, 1, 5): 1,
    }


# centroids


def cluster(rows, k, rounds, scale=256):
    """Brute force in Python's integers."""
    points = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    centres = [v for _, _, v in sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), i, v) for i, v in points if i is not None)[:k]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in points:
            groups[best(v)[1]].append(v)
        centres = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if groups[j] else c for j, c in enumerate(centres)]
    return [(i, j, d, centres[j]) for i, v in points for d, j in [best(v)]]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<double>, cluster string, v int").repartition(3)


def test_centroids_match_brute_force(spark):
    pick = random.Random(40)
    # few different values, so that ties are common
    rows = [(i, [pick.choice([-0.5, -0.001, 0.0, 0.001, 0.5, 1.0]) for _ in range(4)]) for i in range(300)]
    rows += [(i, v) for i, v in rows[:40]] + [(1000, rows[0][1]), (None, rows[1][1])]
    for k in (1, 7, 400):
        got = centroids.clustered(vectors(spark, rows), k=k, rounds=3, size=4).collect()
        want = cluster(rows, k, 3)
        assert sorted((r["vec_id"] or -1, r["cluster"], r["distance"]) for r in got) == sorted((i or -1, j, d) for i, j, d, _ in want)
        each = collections.Counter()
        for _, j, d, _ in want:
            each[j] += d
        digests = {j: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for _, j, _, c in want}
        assert {(r["cluster"], r["cluster_inertia"], r["centroid_sha256"], r["inertia"]) for r in got} == {
            (j, each[j], digests[j], sum(each.values())) for j in each
        }


def test_tournament_leaves_the_smaller_number_at_a_tie():
    centres = np.array([[0, 0], [4, 0], [0, 0], [2, 2]], np.int64)
    points = np.array([[2, 0], [2, -3], [0, 0], [4, 0], [2, 2]], np.int64)
    assert centroids.nearest(points, *centroids.bisectors(centres)).tolist() == [0, 0, 0, 1, 3]


def test_centroids_of_odd_vectors(spark):
    none, odd = [None, 1.0], [float("nan"), 1.0]
    rows = [(1, None), (2, []), (3, [1.0]), (4, none), (5, odd), (6, [float("inf"), 0.0]), (7, [0.1, -0.0]), (None, [0.1, 0.0])]
    got = centroids.clustered(vectors(spark, rows), k=3, size=2).collect()
    assert sorted((r["vec_id"] or 0, r["cluster"], r["distance"]) for r in got) == [(0, 0, 0), (7, 0, 0)]
    alone = centroids.clustered(vectors(spark, [(None, [0.5, 0.5]), (None, [0.25, 1.0])]), k=3, size=2, rounds=0).collect()
    assert sorted(r["distance"] for r in alone) == [0, 64 * 64 + 128 * 128]
    assert centroids.clustered(vectors(spark, []), size=2).count() == 0
    with pytest.raises(ValueError):
        centroids.clustered(vectors(spark, rows), k=5000)
    with pytest.raises(Exception, match="too large"):
        centroids.clustered(vectors(spark, [(1, [1e300, 0.0])]), size=2)


# ranked search


def ranked(docs, items, k):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))

    rows = [(i, collections.Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    count, total = len(rows), sum(n for _, _, n in rows)
    df = collections.Counter(t for _, own, _ in rows for t in own)
    out = []
    for item, text in items:
        scores = []
        for i, own, n in rows:
            m = 25 + (75 * n * count) // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * own[t]) // (1000 * own[t] + 8 * m)) for t in terms(text) if own[t]
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def asked(spark, rows):
    return spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "item_id bigint, text string, m int, score string")


@pytest.mark.parametrize("postings, item_bytes", [(1 << 18, 8 << 20), (60, 300)])
def test_search_matches_brute_force(spark, monkeypatch, postings, item_bytes):
    """Also over pieces of strata and several passes."""
    monkeypatch.setattr(search, "PIECE_POSTINGS", postings)
    monkeypatch.setattr(search, "ITEM_BYTES", item_bytes)
    monkeypatch.setattr(search, "SCORES", 500)
    texts = [(i, t) for i, t in enumerate(prose(50, 300, 25))] + [(400, "Ünï-ÜNÏ a1_a1"), (401, "the\x00end"), (None, "abc ünï"), (3, "ünï a1")]
    texts += [(500 + i, texts[5][1]) for i in range(30)]
    items = list(enumerate(prose(51, 25, 12))) + [(90, texts[5][1].upper()), (91, "ünï ÜNï a1 a1 a1"), (92, ""), (93, None), (94, "nowhere!"), (None, texts[7][1])]
    items += [(95, " ".join(t for _, t in texts[:20]))]
    got = search.search(documents(spark, texts), asked(spark, items), k=10)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked(texts, items, 10)


def test_search_of_odd_rows(spark):
    # the long text is of one word, which is the only one asked for
    items = [(1, "word"), (1, "word"), (1, "x"), (2, "▁")]
    got = {tuple(r)[:3] for r in search.search(documents(spark, ODD), asked(spark, items)).collect()}
    assert {r for r in got if r[0] == 1 and r[2] == 6} == {(1, 1, 6)}
    assert {(r[0], r[2]) for r in got} == {(1, 5), (1, 6), (2, 4)}
    assert search.search(documents(spark, []), asked(spark, items)).count() == 0
    assert search.search(documents(spark, ODD), asked(spark, [])).count() == 0
    assert tiles.similar_documents(documents(spark, [], SCHEMA)).count() == 0
    assert "CartesianProduct" not in plan(search.search(documents(spark, ODD), asked(spark, items)))
