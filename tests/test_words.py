from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import plan, rows, values

from rankweave.operators import segment, words


def texts(spark, *items):
    return spark.createDataFrame([(i,) for i in items], "text string")


def test_case_is_kept_and_short_words_are_dropped(spark):
    df = texts(spark, "UP up UP, a 😀 中国! x1", None, "")
    counts = words.word_counts(words.tokenize(df, "text"))
    assert rows(counts) == [("UP", 2), ("up", 1), ("x1", 1), ("中国", 1)]
    stop = spark.createDataFrame([("up",), ("none",), ("up",)], "word string")
    assert rows(words.drop_stop_words(counts, stop)) == [("UP", 2), ("x1", 1), ("中国", 1)]


def test_counts_equal_brute_force_with_a_hot_word(spark):
    rng = random.Random(4)
    docs = [" ".join("hot" if rng.random() < 0.4 else f"w{rng.randint(0, 500)}" for _ in range(60)) for _ in range(200)]
    want = Counter(w for d in docs for w in re.findall(r"\w+", d) if len(w) >= 2)
    df = texts(spark, *docs).repartition(6)
    counts = words.word_counts(words.tokenize(df, "text"))
    assert dict(rows(counts)) == want
    top = [tuple(r) for r in words.top_words(counts, 300).collect()]
    assert top == sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))[:300]
    assert "TakeOrderedAndProject" in plan(words.top_words(counts))


def test_fields_are_counted_apart_in_one_pass(spark):
    df = spark.createDataFrame([("aa bb", "bb"), (None, "bb cc")], "t string, d string")
    got = words.field_word_counts(df, ["t", "d"])
    assert rows(got) == [("d", "bb", 2), ("d", "cc", 1), ("t", "aa", 1), ("t", "bb", 1)]
    top = words.top_words(got, 1, "field")
    assert rows(top) == [("d", "bb", 2), ("t", "aa", 1)]


def test_callable_segmenter(spark):
    got = words.tokenize_with(texts(spark, "ab|c| de　|", None), "text", lambda t: t.split("|"))
    assert sorted(values(got)) == ["ab", "de"]


def test_a_segmenter_is_made_once_in_each_task(spark):
    def segmenter():
        import uuid

        own = uuid.uuid4().hex
        return lambda text: [own, *text.split("|")]

    df = spark.createDataFrame([(i, "ab|c| de　|" if i % 5 else None) for i in range(40)], "i int, text string").repartition(3)
    got = words.tokenize_by(df, "text", segmenter, ["i"])
    made = [r["word"] for r in got.collect() if len(r["word"]) == 32]
    assert len(made) == 32 and len(set(made)) <= 3
    assert rows(got.where("length(word) < 32")) == sorted([(i, w) for i in range(40) if i % 5 for w in ("ab", "de")], key=repr)
    physical = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in physical and "NestedLoop" not in physical


DICTIONARY = [("中国", 100), ("游戏", 80), ("中", 5), ("国游", 1), ("国", 5), ("中国人", 30), ("人民", 60), ("研究", 50), ("研究生", 40), ("生命", 45), ("命", 4), ("起源", 20)]


def dictionary(spark):
    return spark.createDataFrame(DICTIONARY, "word string, freq long")


def cut(spark, method, *pieces):
    df = spark.createDataFrame([(p,) for p in pieces], "piece string")
    return {r["piece"]: r["words"] for r in segment.segment(df, dictionary(spark), method).collect()}


@pytest.fixture(params=["broadcast", "join"])
def both_ways(request, monkeypatch):
    if request.param == "join":
        monkeypatch.setattr(segment, "MOST_WORDS", 0)
    return request.param


def test_segment_likeliest_and_longest(spark, both_ways):
    assert cut(spark, segment.LIKELIEST, "中国游戏", "研究生命起源", "龘龘") == {
        "中国游戏": ["中国", "游戏"],
        "研究生命起源": ["研究", "生命", "起源"],
        "龘龘": ["龘", "龘"],
    }
    assert cut(spark, segment.LONGEST, "研究生命起源") == {"研究生命起源": ["研究生", "命", "起源"]}


def brute_best(piece):
    from math import log

    freq = dict(DICTIONARY)
    total = log(sum(freq.values()))
    options = [([], 0.0)] if not piece else []
    for n in range(1, len(piece) + 1):
        if n == 1 or piece[:n] in freq:
            rest, score = brute_best(piece[n:])
            options.append(([piece[:n], *rest], score + log(freq.get(piece[:n], 1)) - total))
    return max(options, key=lambda o: o[1])


def test_segment_finds_the_best_of_all_paths(spark, both_ways):
    rng = random.Random(5)
    pieces = {"".join(rng.choice("中国游戏人民研究生命起源") for _ in range(rng.randint(1, 9))) for _ in range(60)}
    got = cut(spark, segment.LIKELIEST, *pieces)
    freq = dict(DICTIONARY)
    for piece in pieces:
        from math import isclose, log

        total = log(sum(freq.values()))
        score = sum(log(freq.get(w, 1)) - total for w in got[piece])
        assert "".join(got[piece]) == piece
        # whole millionths, one rounding for each word
        assert isclose(score, brute_best(piece)[1], abs_tol=1e-5)


def test_dictionary_counts_mix_scripts(spark, both_ways):
    df = texts(spark, "中国游戏GTA5，中国人!", "中国游戏", None, "abc中国")
    got = segment.dictionary_word_counts(df, "text", dictionary(spark))
    assert rows(got) == [("GTA5", 1), ("abc", 1), ("中国", 3), ("中国人", 1), ("游戏", 2)]


def test_dictionary_words_that_mix_scripts(spark, both_ways):
    mixed = spark.createDataFrame([("B站", 30), ("T恤", 20), ("卡拉OK", 20), ("中国", 50), ("TA", 90), ("x" * 40 + "国", 9)], "word string, freq long")
    df = texts(spark, "B站中国", "中国T恤GTA5", "唱卡拉OK吧", "OK", "AB站", "x" * 40 + "国中国TA")
    for method in (segment.LIKELIEST, segment.LONGEST):
        got = segment.dictionary_word_counts(df, "text", mixed, method=method, min_length=1)
        expected = [("A", 1), ("B站", 2), ("GTA5", 1), ("OK", 1), ("TA", 1), ("T恤", 1), ("x" * 40 + "国", 1), ("中国", 3), ("卡拉OK", 1), ("吧", 1), ("唱", 1)]
        assert sorted(rows(got)) == sorted(expected)


def test_long_runs_are_cut(spark):
    df = texts(spark, "x" * 200_000 + "中国")
    got = segment.dictionary_word_counts(df, "text", dictionary(spark))
    assert rows(got) == sorted([("x" * 200_000, 1), ("中国", 1)], key=repr)


def test_one_long_word_is_bounded_by_its_characters(spark, monkeypatch):
    long = spark.createDataFrame([("中" * 20_000, 1), ("中国", 1)], "word string, freq long")
    df = spark.createDataFrame([("中国中国",), ("中" * 20_001,)], "piece string")
    want = [["中国", "中国"], ["中" * 20_000, "中"]]
    assert [r["words"] for r in segment.segment(df, long).collect()] == want
    monkeypatch.setattr(segment, "_segment_by_broadcast", None)
    monkeypatch.setattr(segment, "MOST_BYTES", 20 * 20_000)
    assert [r["words"] for r in segment.segment(df.limit(1), long).collect()] == want[:1]


def test_trie_finds_all_words():
    rng = random.Random(7)
    words = sorted({"".join(rng.choices("ab国𠀀", k=rng.randint(1, 6))) for _ in range(300)})
    rng.shuffle(words)
    keys, weights = segment.trie(words, list(range(len(words))))
    beginnings = {w[:n] for w in words for n in range(1, len(w) + 1)}
    assert len(keys) == len(weights) - 1 == len(beginnings) and (np.diff(keys) > 0).all()
    pieces = ["".join(rng.choices("ab国𠀀x", k=rng.randint(0, 12))) for _ in range(100)]
    for piece, found in zip(pieces, segment.word_finder()(keys, weights, pieces)):
        want = {}
        for start in range(len(piece)):
            for end in range(start + 1, len(piece) + 1):
                if piece[start:end] in words:
                    want.setdefault(start, []).append((end - start, words.index(piece[start:end])))
        assert found == want
    assert list(segment.word_finder()(*segment.trie([], []), ["ab", ""])) == [{}, {}]


def test_dictionary_counts_by_group(spark, both_ways):
    df = spark.createDataFrame([("a", "中国游戏"), ("b", "中国游戏"), ("b", "中国游戏 中国")], "g string, text string")
    got = segment.dictionary_word_counts(df, "text", dictionary(spark), ["g"])
    assert rows(got) == [("a", "中国", 1), ("a", "游戏", 1), ("b", "中国", 3), ("b", "游戏", 2)]


def test_empty_dictionary_cuts_into_characters(spark, both_ways):
    df = spark.createDataFrame([("中国",)], "piece string")
    empty = spark.createDataFrame([], "word string, freq long")
    assert [r["words"] for r in segment.segment(df, empty).collect()] == [["中", "国"]]


def test_the_path_finder_travels_without_the_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    parts = segment.path_finder(-5.0, segment.LIKELIEST), segment.word_finder(), segment.trie(["ab"], [-1])
    (tmp_path / "find").write_bytes(cloudpickle.dumps(parts))
    code = "import pickle; f, w, t = pickle.load(open('find', 'rb')); print(f('abc', *w(*t, ['abc'])))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={})
    assert done.stdout.strip() == "['ab', 'c']", done.stderr
