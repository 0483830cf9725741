from __future__ import annotations

import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from rankweave.functions import numeric, text


def apply(spark, expression, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}").coalesce(1)
    return values(df.orderBy("i").select(expression(F.col("v"))))


def test_clean_text_cases(spark):
    got = apply(spark, text.clean_text, ["　a\tb\n", "a ", "​a", None, "", "\r\n", "a\r\nb"])
    assert got == ["a b", "a", "​a", "", "", "", "a  b"]


def test_strip_equals_python_strip_on_random_text(spark):
    rng = random.Random(1)
    alphabet = list("ab😀é中") + [chr(c) for c in (9, 10, 11, 28, 31, 32, 133, 160, 0x2003, 0x2029, 0x3000, 0x200B, 0xFEFF)]
    inputs = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9))) for _ in range(2000)]
    assert apply(spark, text.strip_unicode, inputs) == [v.strip() for v in inputs]


@pytest.mark.parametrize("every", [1, 6, 12])
def test_wrap_equals_slicing(spark, every):
    inputs = ["", "a", "abcdefghijkl", "abcdefghijklm", "abcdefghijklmnopqrstuvwxyz", "😀" * 25, "中" * 13]
    want = ["\n".join(v[i : i + every] for i in range(0, len(v), every)) for v in inputs]
    assert apply(spark, lambda c: text.wrap_text(c, every), inputs) == want


def test_wrap_needs_a_width():
    with pytest.raises(ValueError):
        text.wrap_text(F.lit("a"), 0)


def test_fill_empty(spark):
    df = spark.createDataFrame([("", "t"), ("d", "t")], "d string, t string").coalesce(1)
    assert values(df.select(text.fill_empty(F.col("d"), F.col("t")))) == ["t", "d"]


def test_display_name_falls_back_to_the_code(spark):
    assert apply(spark, lambda c: text.display_name(c, {"a": "A"}), ["a", "b"]) == ["A", "b"]
    assert apply(spark, lambda c: text.display_name(c, {}), ["a"]) == ["a"]


def test_digest_tells_parts_and_nulls_apart(spark):
    parts = [("a", "bc"), ("ab", "c"), ("", None), (None, ""), (None, None), ("~", None), ("1:a", ""), ("a", "")]
    df = spark.createDataFrame(parts, "x string, y string")
    assert df.select(text.digest(F.col("x"), F.col("y"))).distinct().count() == len(parts)


def test_number(spark):
    inputs = ["12", " 12 ", "1e3", "abc", "", None, "1.7", ".5", "5.", "-3", "12d", "1f", "1_000", "inf", "NaN", "1e400", "0x10"]
    want = [12, 12, 1000, None, None, None, 1.7, 0.5, 5, -3] + [None] * 7
    assert apply(spark, numeric.number, inputs) == want


def test_whole_number_cuts_towards_zero_and_keeps_large_integers(spark):
    inputs = ["1.7", "0.5", "-1.7", "1e3", "9007199254740993", "9223372036854775807", "1e30", "x"]
    want = [1, 0, -1, 1000, 9007199254740993, 9223372036854775807, None, None]
    assert apply(spark, numeric.whole_number, inputs) == want
