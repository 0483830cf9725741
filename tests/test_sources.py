from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.sinks import write_result, write_tsv
from rankweave.sources import envelopes, tables


def item(title, **stat):
    return {"title": title, "tname": "n", "owner": {"name": "u"}, "stat": stat, "bvid": "ignored"}


def write(folder, name, value):
    path = folder / name
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")


def test_files_to_records_with_position(spark, tmp_path):
    write(tmp_path, "issue_2.json", {"data": {"config": {"name": "第2期"}, "list": [item("a", view=1), item("b", view="x")]}})
    write(tmp_path, "issue_10.json", {"data": {"config": None, "list": [{"title": "c"}]}})
    write(tmp_path, "issue_3.json", {"data": None})
    write(tmp_path, "issue_4.json", {"data": {"list": None}})
    accepted, rejected = envelopes.split_payloads(envelopes.read_payloads(spark, f"{tmp_path}/issue_*.json"))
    records = envelopes.envelope_records(accepted).select("file_name", "pos", "period", "up", "title", "view")
    assert rows(records) == [
        ("issue_10.json", 0, "", None, "c", None),
        ("issue_2.json", 0, "第2期", "u", "a", "1"),
        ("issue_2.json", 1, "第2期", "u", "b", "x"),
    ]
    assert rows(envelopes.documents_without_items(accepted).select("file_name")) == [("issue_3.json",), ("issue_4.json",)]
    assert rejected.count() == 0


BAD = {
    "broken.json": "{broken",
    "blank.json": " \n",
    "trailing.json": '{"data": {"list": []}} x',
    "two.json": '{"data": {}}{"data": {}}',
    "brace.json": '{"data": {}}}',
    "array.json": '[{"data": {}}]',
    "null.json": "null",
    "single_quotes.json": "{'data': {}}",
    "wrong_type.json": '{"data": {"list": [{"title": "t", "stat": "x"}]}}',
    "null_item.json": '{"data": {"list": [null]}}',
}


def test_a_bad_file_is_rejected_whole_and_named(spark, tmp_path):
    for name, value in BAD.items():
        write(tmp_path, name, value)
    write(tmp_path, "good.json", {"data": {"list": [item("a")]}})
    write(tmp_path, "pretty.json", json.dumps({"data": {"list": [item("b")]}}, indent=2) + "\n")
    payloads = envelopes.read_payloads(spark, str(tmp_path))
    accepted, rejected = envelopes.split_payloads(payloads)
    assert rows(accepted.select("file_name")) == [("good.json",), ("pretty.json",)]
    reasons = {row["file_name"]: row["reason"] for row in rejected.collect()}
    assert reasons == {name: "null_item" if name == "null_item.json" else "unparseable" for name in BAD}


def test_files_that_are_no_text_are_refused_and_named(spark, tmp_path):
    good = '{"data": {"config": {"name": "é"}, "list": [{"title": "t"}]}}'
    files = {
        "good.json": good.encode(),
        "a b+c%41.json": good.encode(),
        "none + at.json": b"",
        "latin.json": good.encode("latin-1"),
        "cut.json": good.encode()[:-20] + b"\xf0\x9f",
        "mark.json": b"\xef\xbb\xbf" + good.encode(),
        "large.json": good.encode() + b" " * 500,
        "sub/good.json": b"",
        "sub/cut.json": b"{",
    }
    for name, content in files.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    payloads = envelopes.read_payloads(spark, f"{tmp_path}/in/*.json", most_bytes=200).unionByName(envelopes.read_payloads(spark, f"{tmp_path}/in/sub"))
    documents = envelopes.parse_payloads(payloads)
    reasons = {
        "a b+c%41.json": None, "cut.json": "undecodable", "good.json": None, "large.json": "too_large", "latin.json": "undecodable",
        "mark.json": "unparseable", "none + at.json": "empty",
    }
    got = documents.withColumn("sub", F.col("file_path").contains("/sub/")).select("sub", "file_name", "reason")
    assert rows(got) == sorted([(False, *x) for x in reasons.items()] + [(True, "good.json", "empty"), (True, "cut.json", "unparseable")], key=repr)
    kept = {r[0]: bytes(r[1]) for r in envelopes.refused(documents).where("reason = 'undecodable'").select("file_name", F.col("payload").cast("binary")).collect()}
    assert kept == {name: files[name] for name in ("latin.json", "cut.json")}
    assert documents.where("reason is null").select("file_path").distinct().count() == 2


def test_large_files_are_not_read(spark, tmp_path):
    (tmp_path / "one.json").write_bytes(b"x" * 50)
    large = envelopes.read_payloads(spark, str(tmp_path), most_bytes=10).where("fault = 'too_large'")
    assert rows(large.select("file_name", "payload")) == [("one.json", None)]
    assert "ReadSchema: struct<length:bigint>" in large._jdf.queryExecution().toString()


def test_lines_that_are_no_text_are_refused(spark, tmp_path):
    (tmp_path / "lines.txt").write_bytes(b'{"data": null}\n\xff\n')
    documents = envelopes.parse_payloads(envelopes.read_payloads(spark, str(tmp_path), one_per_file=False))
    assert rows(documents.select("reason")) == [("undecodable",), (None,)]


def test_null_payload_is_rejected(spark):
    df = spark.createDataFrame([(1, None), (2, '{"data": {}}')], "id int, payload string")
    accepted, rejected = envelopes.split_payloads(df)
    assert rows(accepted.select("id")) == [(2,)]
    assert rows(rejected) == [(1, None, "unparseable")]


SCHEMA = T.StructType().add("a", "string").add("n", "long").add("z", "string")


def test_tsv_accepts_and_rejects_by_position(spark, tmp_path):
    lines = ['"q\t1\tz', "b\t2\t", "c\tx\tz", "d\t1", "e\t1\tz\textra", "", "f\t 7 \tz", "g\t1.5\tz"]
    write(tmp_path, "part.txt", "\n".join(lines) + "\n")
    assert rows(tables.read_tsv(spark, str(tmp_path), SCHEMA)) == [('"q', 1, "z"), ("b", 2, ""), ("f", 7, "z")]
    assert rows(tables.read_tsv_rejects(spark, str(tmp_path), SCHEMA)) == [
        ("", "field_count"),
        ("c\tx\tz", "not_a_number"),
        ("d\t1", "field_count"),
        ("e\t1\tz\textra", "field_count"),
        ("g\t1.5\tz", "not_a_number"),
    ]
    assert tables.read_tsv(spark, str(tmp_path), SCHEMA).count() == 3


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('a "b"', 1, ""), ("中", -5, "x\\n")], SCHEMA)
    uri = str(tmp_path / "out")
    write_tsv(df, uri)
    write_tsv(df, uri)
    assert rows(tables.read_tsv(spark, uri, SCHEMA)) == rows(df)


def test_result_round_trip(spark, tmp_path):
    schema = T.StructType.fromDDL("word string, count bigint")
    df = spark.createDataFrame([('say "hi", you', 3), ("", 2), ("a\nb", 1)], schema)
    uri = str(tmp_path / "out")
    write_result(df, uri)
    assert rows(tables.read_result(spark, uri, schema)) == rows(df)


def test_missing_result_is_absent(spark, tmp_path):
    assert tables.read_result(spark, str(tmp_path / "no"), SCHEMA) is None


def test_word_list(spark, tmp_path):
    write(tmp_path, "stop.txt", "the\n  of　\n\n \nthe\nThe\n")
    assert rows(tables.read_word_list(spark, str(tmp_path / "stop.txt"))) == [("The",), ("of",), ("the",)]
    assert rows(tables.read_word_list(spark, str(tmp_path / "no"))) == []
    assert rows(tables.read_word_list(spark, None)) == []


@pytest.mark.parametrize("payload", ['{"k": 1}', ' {"k": 1}\n'])
def test_parse_json_takes_ddl(spark, payload):
    df = spark.createDataFrame([(payload,)], "p string")
    parsed = envelopes.parse_json(df, "p", "k bigint").select(F.col("doc.k"), "is_valid")
    assert rows(parsed) == [(1, True)]


def test_dictionary(spark, tmp_path):
    write(tmp_path, "dict.txt", "中国 100 ns\n游戏 8\n\nplain\n")
    assert rows(tables.read_dictionary(spark, str(tmp_path / "dict.txt"))) == [("plain", 1), ("中国", 100), ("游戏", 8)]
