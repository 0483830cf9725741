from __future__ import annotations

import random

from conftest import plan, rows

from rankweave.operators.dedup import keep_first, mark_first


def table(spark, n=3000):
    rng = random.Random(2)
    # A third of all rows under one key, and a null key.
    keys = ["hot" if rng.random() < 0.33 else rng.choice(["a", "b", "c", None, "d"]) for _ in range(n)]
    return spark.createDataFrame([(k, f"f{rng.randint(0, 20):02d}", i) for i, k in enumerate(keys)], "k string, f string, p int")


def expected(df):
    best = {}
    for row in df.collect():
        if row.k not in best or (row.f, row.p) < (best[row.k].f, best[row.k].p):
            best[row.k] = row
    return sorted((tuple(r) for r in best.values()), key=repr)


def test_keep_first_matches_brute_force_for_any_partitioning(spark):
    df = table(spark)
    want = expected(df)
    for part in (df, df.repartition(7), df.repartition(3, "p")):
        assert rows(keep_first(part, ["k"], ["f", "p"])) == want


def test_file_names_sort_as_text(spark):
    df = spark.createDataFrame([("x", "issue_2.json", 0), ("x", "issue_10.json", 5)], "k string, f string, p int")
    assert rows(keep_first(df, ["k"], ["f", "p"])) == [("x", "issue_10.json", 5)]


def test_group_limit_runs_before_the_shuffle(spark):
    text = plan(keep_first(table(spark), ["k"], ["f", "p"]))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_mark_first_keeps_every_row(spark):
    df = table(spark)
    marked = mark_first(df, ["k"], ["f", "p"], "first")
    assert marked.count() == df.count()
    assert rows(marked.where("first").select("k", "f", "p")) == expected(df)


def test_null_places_mark_one_row(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "b", 2), ("m", None, 3)], "k string, f string, p int")
    marked = mark_first(df, ["k"], ["f", "p"], "first")
    assert rows(marked.where("first").select("k", "p")) == [("k", 1), ("m", 3)] and marked.count() == 3
