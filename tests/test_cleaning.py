from __future__ import annotations

from dataclasses import replace

import pytest
from conftest import rows

from rankweave.operators import cleaning
from rankweave.schemas import BEST_RANK, CLEAN, DISLIKE, METRICS

NUMBERS = [*METRICS, BEST_RANK, DISLIKE]
COLUMNS = ["file_name", "pos", "period", "up", "title", "tname", *NUMBERS, "desc", "rcmd_reason"]
SCHEMA = ", ".join(f"`{c}` {'int' if c == 'pos' else 'string'}" for c in COLUMNS)


def record(**changes):
    base = {"file_name": "issue_1.json", "pos": 0, "period": "p", "up": "u", "title": "t", "tname": "n"}
    base |= {name: "5" for name in NUMBERS} | {DISLIKE: "0", "desc": "d", "rcmd_reason": "r"}
    assert set(changes) <= set(base)
    return tuple((base | changes)[c] for c in COLUMNS)


def frame(spark, *records):
    return spark.createDataFrame(list(records), SCHEMA)


def kept(spark, *records):
    return cleaning.clean(frame(spark, *records)).collect()


def test_result_schema_and_types(spark):
    df = cleaning.clean(frame(spark, record()))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CLEAN]
    assert df.count() == 1


def test_first_duplicate_is_by_file_name_then_position(spark):
    got = kept(
        spark,
        record(file_name="issue_2.json", view="2"),
        record(file_name="issue_10.json", view="10", pos=3),
        record(file_name="issue_10.json", view="11", pos=4),
    )
    assert [row["view"] for row in got] == [10]


def test_an_invalid_first_row_shadows_a_valid_duplicate(spark):
    assert kept(spark, record(his_rank="0"), record(pos=1)) == []


def test_an_incomplete_first_row_does_not(spark):
    assert len(kept(spark, record(view=None), record(pos=1))) == 1


def test_keys_are_compared_before_cleaning(spark):
    got = kept(spark, record(title="a\t"), record(title="a ", pos=1))
    assert [row["title"] for row in got] == ["a", "a"]


@pytest.mark.parametrize(
    ("changes", "survives"),
    [
        ({"up": ""}, True),
        ({"up": None}, False),
        ({"period": None}, True),
        ({"desc": None}, True),
        ({"dislike": None}, False),
        ({"dislike": "1"}, False),
        ({"dislike": "-1"}, True),
        ({"his_rank": "0"}, False),
        ({"view": "abc"}, False),
        ({"view": "inf"}, False),
        ({"view": "1e3"}, True),
        ({"view": "0.5"}, True),
        ({"like": "-3"}, False),
    ],
)
def test_row_rules(spark, changes, survives):
    assert len(kept(spark, record(**changes))) == int(survives)


def test_fill_uses_the_cleaned_title(spark):
    (row,) = kept(spark, record(title=" t ", desc=" \n", rcmd_reason=None))
    assert (row["title"], row["desc"], row["rcmd_reason"]) == ("t", "t", "t")


def mixed(spark):
    records = [record(title=f"t{i}", pos=i) for i in range(20)]
    records += [record(title="hot", pos=100 + i, view=str(i + 1)) for i in range(15)]
    records += [record(title=f"n{i}", pos=200 + i, up=None) for i in range(4)]
    records += [record(title=f"bad{i}", pos=300 + i, coin="0") for i in range(3)]
    records += [record(title=f"e{i}", pos=400 + i, desc="\t", rcmd_reason="") for i in range(2)]
    records += [record(title="shadow", pos=500, like="0"), record(title="shadow", pos=501)]
    return frame(spark, *records)


def test_audit_counts_each_rule(spark):
    want = [
        (1, "drop_null", 46, 42),
        (2, "keep_first", 42, 27),
        (3, "drop_invalid", 27, 23),
        (4, "fill_desc", 23, 2),
        (5, "fill_rcmd_reason", 23, 2),
    ]
    df = mixed(spark)
    assert rows(cleaning.audit(df)) == want
    assert rows(cleaning.audit(df.repartition(7))) == want


def test_every_row_is_kept_or_rejected_with_a_reason(spark):
    df = mixed(spark)
    rejected = cleaning.rejected(df)
    counts = {row["reason"]: row["count"] for row in rejected.groupBy("reason").count().collect()}
    assert counts == {"null_field": 4, "duplicate": 15, "invalid": 4}
    assert cleaning.clean(df).count() + rejected.count() == df.count()
    assert rejected.columns == [*df.columns, "reason"]


def test_long_keys_give_the_same_result(spark):
    df = mixed(spark)
    rules = replace(cleaning.VIDEO_RULES, long_keys=True)
    assert rows(cleaning.clean(df, rules)) == rows(cleaning.clean(df))
    assert rows(cleaning.audit(df, rules)) == rows(cleaning.audit(df))
    assert rows(cleaning.rejected(df, rules)) == rows(cleaning.rejected(df))


def test_empty_input(spark):
    df = frame(spark)
    assert rows(cleaning.clean(df)) == []
    assert cleaning.clean(df).columns == CLEAN.fieldNames()
    assert [row[2:] for row in rows(cleaning.audit(df))] == [(0, 0)] * 5
