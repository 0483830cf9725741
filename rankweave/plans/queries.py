"""Registered queries: each operator on the nearest of the given tables, with SQL for the same result.

The given tables hold no video data and no nulls, so bad values are made from the values of the rows
themselves, over whole tables. Every output column has the same name and type in both forms.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankweave.functions.numeric import number, whole_number
from rankweave.functions.text import WHITE_SPACE_RANGES, clean_text, digest, display_name, fill_empty, wrap_text
from rankweave.operators import cleaning, dedup, learning, ranking, report, segment, statistics, words
from rankweave.sinks import tsv_line, write_result, write_table, write_tsv
from rankweave.sources import envelopes, tables
from rankweave.storage import new_folder
from rankweave.streaming import rankings
from rankweave.streaming.eventtime import first_within_stream
from rankweave.streaming.ingest import audited, clean_stream, keep_first_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query under its function name; without SQL only its rows are checked."""

    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLE[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Unicode white space at both ends, for SQL. {c} is the column.
_CLASS = "".join(
    rf"\x{{{low:x}}}" if low == high else rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in WHITE_SPACE_RANGES
)


def _sql_strip(value: str) -> str:
    return f"regexp_replace({value}, '^[{_CLASS}]+|[{_CLASS}]+$', '', 'g')"


def _sql_clean(value: str) -> str:
    return _sql_strip(f"translate(coalesce({value}, ''), chr(9) || chr(10) || chr(13), '   ')")


# --- sources ---------------------------------------------------------------------------------------


def _document_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per document, an item per line; English documents have no header."""
    docs = table(spark, sf_dir, "documents")
    items = F.transform(
        F.split("text", "\n", -1),
        lambda line: F.struct(
            line.alias("title"),
            F.col("lang").alias("tname"),
            F.struct(F.col("source").alias("name")).alias("owner"),
            F.struct(F.col("n_chars").alias("view")).alias("stat"),
        ),
    )
    header = F.when(F.col("lang") != "en", F.struct(F.col("source").alias("name")))
    envelope = F.struct(F.struct(header.alias("config"), items.alias("list")).alias("data"))
    return docs.select(F.col("doc_id").cast("string").alias("file_name"), F.to_json(envelope).alias("payload"))


def _envelope_rows(accepted: DataFrame) -> DataFrame:
    return envelopes.envelope_records(accepted).select(
        F.col("pos").cast("bigint").alias("pos"),
        "period",
        "up",
        F.md5("title").alias("title_md5"),
        whole_number(F.col("view")).alias("view"),
        "file_name",
    )


_DOCUMENT_LINES = """
    select doc_id, lang, source, n_chars, unnest(string_split(text, chr(10))) as line,
           unnest(range(len(string_split(text, chr(10))))) as pos
    from documents
"""


@register(
    f"""
    select doc_id, cast(pos as bigint) as pos, case when lang <> 'en' then source else '' end as period,
           source as up, md5(line) as title_md5, n_chars as view
    from ({_DOCUMENT_LINES})
    """
)
def q01_envelope_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = envelopes.split_payloads(_document_envelopes(spark, sf_dir))
    return _envelope_rows(accepted).withColumn("doc_id", F.col("file_name").cast("bigint")).drop("file_name")


@register(
    f"""
    select case when lang <> 'en' then source else '' end as period, source as up, n_chars as view,
           cast(pos as bigint) as pos, md5(line) as title_md5, count(*) as n
    from ({_DOCUMENT_LINES}) group by all
    """
)
def q01_envelope_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through files: envelopes written as text, one per line, and read back by the source."""
    landing = new_folder(spark, "landing")
    _document_envelopes(spark, sf_dir).select(F.col("payload").alias("value")).write.text(landing)
    accepted, _ = envelopes.split_payloads(envelopes.read_payloads(spark, landing, one_per_file=False))
    rows = _envelope_rows(accepted)
    return rows.groupBy("period", "up", "view", "pos", "title_md5").agg(F.count(F.lit(1)).alias("n"))


_PAYLOAD = """
    case event_type when 'error' then {cut}
                    when 'click' then concat(props, ' and more')
                    when 'view' then concat('[', props, ']')
                    when 'signup' then ''
                    else props end
"""


@register(
    f"""
    with damaged as (
        select event_id, {_PAYLOAD.format(cut="left(props, length(props) - 1)")} as payload from events
    ), checked as (
        select event_id, payload, coalesce(json_valid(payload), false) as ok from damaged
    ), typed as (
        select event_id, payload, ok and json_type(case when ok then payload else 'null' end) = 'OBJECT' as is_valid
        from checked
    )
    select event_id, is_valid,
           case when is_valid then cast(json_extract_string(payload, '$.k') as bigint) end as k
    from typed
    """
)
def q02_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = _PAYLOAD.format(cut="left(props, length(props) - 1)")
    payloads = table(spark, sf_dir, "events").select("event_id", F.expr(damaged).alias("payload"))
    parsed = envelopes.parse_json(payloads, "payload", "k bigint")
    return parsed.select("event_id", "is_valid", F.when(F.col("is_valid"), F.col("doc.k")).alias("k"))


# --- cleaning --------------------------------------------------------------------------------------

_MIXED = """
    case event_type when 'signup' then {v}
                    when 'purchase' then concat('  ', {v}, ' ')
                    when 'view' then concat({v}, 'e1')
                    when 'error' then concat('n/a ', {v})
                    else case when value < 10 then '' else concat('+', {v}) end end
"""
_VALUE_TEXT = _MIXED.format(v="cast(cast(value as decimal(18, 2)) as {text})")


@register(
    f"""
    select event_id, try_cast(trim(raw) as double) as v_double,
           cast(trunc(try_cast(trim(raw) as double)) as bigint) as v_long
    from (select event_id, {_VALUE_TEXT.format(text='varchar')} as raw from events)
    """
)
def q03_numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select("event_id", F.expr(_VALUE_TEXT.format(text="string")).alias("raw"))
    return raw.select("event_id", number(F.col("raw")).alias("v_double"), whole_number(F.col("raw")).alias("v_long"))


@register(
    """
    select o_orderkey from orders
    where nullif(o_orderstatus, 'P') is not null and nullif(o_orderpriority, '4-NOT SPECIFIED') is not null
    """
)
def q04_null_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"),
    )
    return cleaning.drop_null(orders, ["o_orderstatus", "o_orderpriority"]).select("o_orderkey")


def _documents_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", digest(F.col("text")).alias("text_key"))


@register("select min(doc_id) as doc_id from documents group by text")
def q05_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_first(_documents_by_text(spark, sf_dir), ["text_key"], ["doc_id"]).select("doc_id")


@register("select doc_id, row_number() over (partition by text order by doc_id) = 1 as is_first from documents")
def q05_dedup_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = dedup.mark_first(_documents_by_text(spark, sf_dir), ["text_key"], ["doc_id"], "is_first")
    return marked.select("doc_id", "is_first")


# Rows of one (order, line number) differ in these columns.
_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
LINE_RULES = cleaning.CleanRules(
    order_by=_LINE,
    keys=["l_orderkey", "l_linenumber"],
    required=["flag"],
    positive=["l_quantity", "l_extendedprice", "l_discount"],
    not_above={"l_tax": 0.04},
    whole=["l_quantity"],
    output=["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "flag"],
)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("A")))


_LINES_SQL = """
    lines as (select *, nullif(l_returnflag, 'A') as flag,
                     l_quantity > 0 and l_extendedprice > 0 and l_discount > 0 and l_tax <= 0.04 as ok
              from lineitem),
    whole as (select *, row_number() over (
                  partition by l_orderkey, l_linenumber
                  order by l_partkey, l_suppkey, l_extendedprice, l_shipdate) as nth
              from lines where flag is not null)
"""


@register(
    """
    select l_returnflag, count(*) as n from lineitem
    where l_quantity > 0 and l_extendedprice > 0 and l_discount > 0 and l_tax <= 0.04 group by l_returnflag
    """
)
def q06_validity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = cleaning.valid_rows(table(spark, sf_dir, "lineitem"), LINE_RULES)
    return lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@register(
    f"""
    select doc_id, md5(t) as clean_md5, length(t) as clean_length
    from (select doc_id, {_sql_clean("text")} as t from documents)
    """
)
def q07_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = table(spark, sf_dir, "documents").select("doc_id", clean_text(F.col("text")).alias("t"))
    return cleaned.select(
        "doc_id", F.md5("t").alias("clean_md5"), F.length("t").cast("bigint").alias("clean_length")
    )


@register(
    f"""
    select doc_id, md5(case when t = '' then {_sql_clean("source")} else t end) as filled_md5
    from (select doc_id, source, {_sql_clean("case when lang = 'de' then chr(9) || ' ' || chr(10) else text end")} as t
          from documents)
    """
)
def q08_fill_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanked = F.when(F.col("lang") == "de", "\t \n").otherwise(F.col("text"))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", clean_text(blanked).alias("t"), clean_text(F.col("source")).alias("s")
    )
    return docs.select("doc_id", F.md5(fill_empty(F.col("t"), F.col("s"))).alias("filled_md5"))


# Documents of one issue file, by their numbers.
ISSUE_DOCUMENTS = 50


def _issue_files(spark: SparkSession, sf_dir: str) -> str:
    """Documents as issue files, each in a folder of its own, where Spark names them alike.

    Of five files one is cut off, one has a byte that is no UTF-8, one has text after its end. The driver adds one
    file of zero bytes, which no writer makes.
    """
    docs = table(spark, sf_dir, "documents").withColumn("part", F.floor(F.col("doc_id") / ISSUE_DOCUMENTS))
    item = F.struct(F.col("doc_id"), F.col("source").alias("title"))
    lists = docs.groupBy("part").agg(F.sort_array(F.collect_list(item)).alias("list"))
    whole = F.to_json(F.struct(F.struct(F.transform("list", lambda x: F.struct(x["title"])).alias("list")).alias("data")))
    half = (F.length("whole") / 2).cast("int")
    damaged = (
        F.when(F.col("part") % 5 == 1, F.substring("whole", F.lit(1), half))
        .when(F.col("part") % 5 == 2, F.concat(F.encode(F.substring("whole", F.lit(1), half), "UTF-8"), F.unhex(F.lit("FF")), F.encode(F.substring(F.col("whole"), half + 1, F.length("whole")), "UTF-8")).cast("string"))
        .when(F.col("part") % 5 == 3, F.concat("whole", F.lit("{}")))
        .otherwise(F.col("whole"))
    )
    landing = new_folder(spark, "issue-files")
    lists.select("part", whole.alias("whole")).select("part", damaged.alias("value")).write.partitionBy("part").text(landing)
    empty = spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/part=-1/part-empty.txt")
    empty.getFileSystem(spark._jsc.hadoopConfiguration()).create(empty).close()
    return landing


@register(
    f"""
    select cast(floor(doc_id / {ISSUE_DOCUMENTS}) as bigint) as part, count(*) as n_documents,
           case cast(floor(doc_id / {ISSUE_DOCUMENTS}) as bigint) % 5 when 1 then 'unparseable' when 2 then 'undecodable' when 3 then 'unparseable' else 'accepted' end as state,
           case when cast(floor(doc_id / {ISSUE_DOCUMENTS}) as bigint) % 5 in (0, 4) then count(*) else 0 end as n_items
    from documents group by 1
    union all select -1, 0, 'empty', 0
    """
)
def q02_quarantine_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issue files read whole: each is accepted or named with the reason it is refused for; none gets lost or mended."""
    payloads = envelopes.read_payloads(spark, f"{_issue_files(spark, sf_dir)}/*/*.txt")
    read = envelopes.parse_payloads(payloads)
    part = F.regexp_extract("file_path", r"/part=(-?\d+)/", 1).cast("bigint").alias("part")
    files = read.select(part, F.coalesce("reason", F.lit("accepted")).alias("state"), F.coalesce(F.size("doc.data.list"), F.lit(0)).cast("bigint").alias("n_items"))
    docs = table(spark, sf_dir, "documents").groupBy(F.floor(F.col("doc_id") / ISSUE_DOCUMENTS).alias("part")).agg(F.count(F.lit(1)).alias("n_documents"))
    return files.join(docs, "part", "left").select("part", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), "state", "n_items")


@register(
    f"""
    with {_LINES_SQL}
    select cast(1 as bigint) as step, 'drop_null' as rule, (select count(*) from lines) as rows_in,
           (select count(*) from whole) as rows_out
    union all
    select 2, 'keep_first', (select count(*) from whole), (select count(*) from whole where nth = 1)
    union all
    select 3, 'drop_invalid', (select count(*) from whole where nth = 1),
           (select count(*) from whole where nth = 1 and ok)
    """
)
def q09_clean_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.audit(_lines(spark, sf_dir), LINE_RULES)


@register(
    f"""
    with {_LINES_SQL}
    select l_orderkey, l_linenumber, l_extendedprice, cast(trunc(l_quantity) as bigint) as l_quantity, flag
    from whole where nth = 1 and ok
    """
)
def q09_clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(_lines(spark, sf_dir), LINE_RULES)


@register(
    f"""
    with {_LINES_SQL}
    select 'null_field' as reason, l_orderkey, count(*) as n from lines where flag is null group by l_orderkey
    union all
    select case when nth > 1 then 'duplicate' else 'invalid' end, l_orderkey, count(*)
    from whole where nth > 1 or not ok group by 1, 2
    """
)
def q09_clean_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select(*_LINE, "l_quantity", "l_discount", "l_tax", "flag")
    refused = cleaning.rejected(lines, LINE_RULES)
    return refused.groupBy("reason", "l_orderkey").agg(F.count(F.lit(1)).alias("n"))


_DOCUMENT_RULES = cleaning.CleanRules(
    order_by=["doc_id"],
    keys=["lang", "text"],
    required=["lang", "text"],
    positive=["n_chars"],
    not_above={"n_chars": 5000.0},
    text=["text", "source", "note"],
    fill={"note": "source"},
    whole=["n_chars"],
    output=["doc_id", "n_chars", "text", "source", "note"],
    long_keys=True,
)


def _noted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.when(F.col("lang") == "de", "\n \t").otherwise(F.concat(F.lit(" "), "lang"))
    return table(spark, sf_dir, "documents").withColumn("note", note)


_NOTED_SQL = """
    firsts as (select *, case when lang = 'de' then '' else lang end as note
               from documents qualify row_number() over (partition by lang, text order by doc_id) = 1)
"""


@register(
    f"""
    with {_NOTED_SQL}
    select doc_id, n_chars, md5({_sql_clean("text")}) as text_md5, case when note = '' then source else note end as note
    from firsts where n_chars > 0 and n_chars <= 5000
    """
)
def q09_clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaning.clean(_noted_documents(spark, sf_dir), _DOCUMENT_RULES)
    return cleaned.select("doc_id", "n_chars", F.md5("text").alias("text_md5"), "note")


@register(
    f"""
    with {_NOTED_SQL}, ok as (select * from firsts where n_chars > 0 and n_chars <= 5000)
    select cast(1 as bigint) as step, 'drop_null' as rule, (select count(*) from documents) as rows_in,
           (select count(*) from documents) as rows_out
    union all
    select 2, 'keep_first', (select count(*) from documents), (select count(*) from firsts)
    union all
    select 3, 'drop_invalid', (select count(*) from firsts), (select count(*) from ok)
    union all
    select 4, 'fill_note', (select count(*) from ok), (select count(*) from ok where note = '')
    """
)
def q09_clean_documents_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.audit(_noted_documents(spark, sf_dir), _DOCUMENT_RULES)


# --- tab-separated text ----------------------------------------------------------------------------

_CUSTOMER = (
    StructType()
    .add("c_custkey", "long")
    .add("c_name", "string")
    .add("c_nationkey", "long")
    .add("c_acctbal", "double")
    .add("c_mktsegment", "string")
)


def _customer_lines(spark: SparkSession, sf_dir: str) -> str:
    """Customers as lines: no last field where the balance is negative, no number as key for BUILDING."""
    customers = table(spark, sf_dir, "customer")
    key = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("x"), F.col("c_custkey"))).otherwise(
        F.col("c_custkey").cast("string")
    )
    money = F.col("c_acctbal").cast("decimal(18,2)").cast("string")
    fields = customers.select(key.alias("c_custkey"), "c_name", "c_nationkey", money.alias("c_acctbal"), "c_mktsegment")
    uri = new_folder(spark, "customer_tsv")
    write_tsv(fields, uri)
    # the second write replaces the first; a row that is one field short is a line of its own shape
    line = F.when(F.col("c_acctbal").startswith("-"), tsv_line(fields.drop("c_mktsegment"))).otherwise(tsv_line(fields))
    write_tsv(fields.select(line.alias("line")), uri)
    return uri


@register(
    """
    select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal, c_mktsegment from customer
    where c_acctbal >= 0 and c_mktsegment <> 'BUILDING'
    """
)
def q10_tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_tsv(spark, _customer_lines(spark, sf_dir), _CUSTOMER)


@register(
    """
    select case when c_acctbal < 0 then 'field_count' else 'not_a_number' end as reason, count(*) as n
    from customer where c_acctbal < 0 or c_mktsegment = 'BUILDING' group by 1
    """
)
def q10_tsv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = tables.read_tsv_rejects(spark, _customer_lines(spark, sf_dir), _CUSTOMER)
    return refused.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# --- rankings --------------------------------------------------------------------------------------

_MONEY = "cast(sum(cast({c} as decimal(20, 2))) as double)"
_LINE_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("select o_custkey, count(o_custkey) as n from orders group by 1 order by n desc, o_custkey limit 10")
def q11_group_count_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_groups(table(spark, sf_dir, "orders"), "o_custkey", out="n")


@register("select o_custkey, count(o_custkey) as n from orders group by 1 order by n desc, o_custkey limit 10")
def q11_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a registered view."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("data")
    return spark.sql(
        "SELECT o_custkey, COUNT(o_custkey) AS n FROM data GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10"
    )


@register("select p_type, count(p_type) as n from part group by 1 order by n desc, p_type limit 10")
def q11_category_count_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_groups(table(spark, sf_dir, "part"), "p_type", out="n")


@register(
    """
    select l_orderkey, l_partkey, l_suppkey, l_extendedprice from lineitem
    order by l_extendedprice desc, l_orderkey, l_partkey, l_suppkey limit 10
    """
)
def q12_row_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_suppkey"]
    return ranking.top_rows(table(spark, sf_dir, "lineitem"), "l_extendedprice", columns)


def _rows_by_metric_sql(metrics: list[str]) -> str:
    parts = [
        f"(select '{m}' as metric, l_orderkey, l_partkey, l_suppkey, {m} as value, cast(row_number() over "
        f"(order by {m} desc, l_orderkey, l_partkey, l_suppkey) as bigint) as rank from lineitem)"
        for m in metrics
    ]
    return f"select * from ({' union all '.join(parts)}) where rank <= 10"


@register(_rows_by_metric_sql(_LINE_METRICS))
def q12_row_topk_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_suppkey"]
    return ranking.top_rows_by_metric(table(spark, sf_dir, "lineitem"), columns, _LINE_METRICS)


@register(
    f"""
    select o_custkey, {_MONEY.format(c="o_totalprice")} as total from orders
    group by 1 order by total desc, o_custkey limit 10
    """
)
def q13_group_sum_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_group_sums(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", scale=2)


def _totals_by_metric_sql(key: str, source: str, metrics: list[str]) -> str:
    parts = [
        f"(select '{m}' as metric, {key}, total, cast(row_number() over (order by total desc, {key}) as bigint) as rank "
        f"from (select {key}, {_MONEY.format(c=m)} as total from {source} group by {key}))"
        for m in metrics
    ]
    return f"select metric, rank, {key}, total from ({' union all '.join(parts)}) where rank <= 10"


@register(_totals_by_metric_sql("l_suppkey", "lineitem", _LINE_METRICS))
def q14_all_metrics_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return ranking.top_group_sums_by_metric(lines, "l_suppkey", _LINE_METRICS, scale=2)


# --- words -----------------------------------------------------------------------------------------

_BREAK = r"[^\p{L}\p{N}]+"


def _sql_tokens(source: str, column: str = "text") -> str:
    return f"select unnest(regexp_split_to_array({column}, '{_BREAK}')) as word from {source}"


@register(
    f"""
    with tokens as (
        select 'documents' as field, * from ({_sql_tokens("documents")})
        union all select 'conversations', * from ({_sql_tokens("conversations")})
    ), counts as (select field, word, count(*) as count from tokens where length(word) >= 2 group by 1, 2)
    select field, word, count from counts
    qualify row_number() over (partition by field order by count desc, word) <= 300
    """
)
def q15_wordcount_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = [
        table(spark, sf_dir, name).select(F.lit(name).alias("field"), "text")
        for name in ("documents", "conversations")
    ]
    tokens = words.tokenize(report.union_all(texts), "text", ["field"])
    return words.top_words(words.word_counts(tokens, ["field"]), 300, "field")


@register(
    f"""
    select word, count(*) as count
    from (select {_sql_strip("word")} as word from (select unnest(string_split(text, ' ')) as word from conversations))
    where length(word) >= 2 group by 1 order by count desc, word limit 300
    """
)
def q15_wordcount_callable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a caller's segmenter, made once in each task."""

    def segmenter():
        import re

        return re.compile(" ").split

    tokens = words.tokenize_by(table(spark, sf_dir, "conversations"), "text", segmenter)
    return words.top_words(words.word_counts(tokens), 300)


def _dictionary_sql(method: str) -> str:
    """Words of the best path by a fold over the places of a piece from its end, and a walk from its start.

    The words of `benchmark` hold letters only, so a run of other characters stays whole.
    """
    best = {
        "likeliest": "list_max(list_transform(x.options, lambda o: {'v': o.w + acc.scores[o.n], 'n': o.n}))",
        "longest": "list_max(list_transform(x.options, lambda o: {'v': CAST(o.known AS BIGINT) * 100000 + o.n, 'n': o.n}))",
    }[method]
    return f"""
    with recursive counted as (
        select word, count(*) as freq from ({_sql_tokens("benchmark")}) where length(word) >= 2 group by 1),
    total as (select cast(round(-ln(sum(freq)) * 1e6) as bigint) as unknown, -ln(sum(freq)) as whole from counted),
    dictionary as (select word, length(word) as n, cast(round((ln(freq) + whole) * 1e6) as bigint) as w from counted, total),
    pieces as (
        select piece, count(*) as times, row_number() over (order by piece) as id
        from (select unnest(regexp_extract_all(replace(text, ' ', ''), '[\\p{{L}}\\p{{N}}]+')) as piece from documents) group by 1),
    places as (select id, piece, unnest(range(1, length(piece) + 1)) as pos from pieces where regexp_matches(piece, '\\p{{L}}')),
    found as (
        select id, pos, d.n, d.w, true as known
        from (select id, pos, substring(piece, pos, n) as word from places, (select distinct n from dictionary) where pos + n - 1 <= length(piece))
        join dictionary d using (word)
        union all
        select id, pos, case when regexp_matches(substring(piece, pos, 1), '\\p{{L}}') then 1 else length(regexp_extract(substring(piece, pos), '^[^\\p{{L}}]+')) end, unknown, false from places, total),
    options as (select id, pos, list({{'n': n, 'w': w, 'known': known}}) as options from found group by 1, 2),
    listed as (
        select id, list({{'options': options, 'scores': cast([] as bigint[]), 'steps': cast([] as bigint[])}} order by pos desc) as xs
        from options group by 1),
    steps as (
        select id, list_reduce(xs, lambda acc, x: struct_pack(options := x.options,
            scores := list_concat([{best}.v], acc.scores[1:400]), steps := list_concat([{best}.n], acc.steps)),
            {{'options': cast([] as struct(n bigint, w bigint, known boolean)[]), 'scores': cast([0] as bigint[]), 'steps': cast([] as bigint[])}}).steps as steps
        from listed),
    walk as (
        select id, 1 as pos, steps from steps
        union all select id, cast(pos + steps[pos] as integer), steps from walk where pos + steps[pos] <= len(steps)),
    cut as (select substring(piece, pos, steps[pos]) as word, times from walk join pieces using (id)
            union all select piece, times from pieces where not regexp_matches(piece, '\\p{{L}}'))
    select word, cast(sum(times) as bigint) as count from cut where length(word) >= 2 group by 1 order by count desc, word limit 300
    """


def _unspaced_word_counts(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    """Documents with their spaces taken out, cut by the words of `benchmark`."""
    vocabulary = words.word_counts(words.tokenize(table(spark, sf_dir, "benchmark"), "text"))
    dictionary = vocabulary.select("word", F.col("count").alias("freq"))
    unspaced = table(spark, sf_dir, "documents").select(F.replace("text", F.lit(" "), F.lit("")).alias("text"))
    return words.top_words(segment.dictionary_word_counts(unspaced, "text", dictionary, script=r"\p{L}", method=method), 300)


@register(_dictionary_sql(segment.LIKELIEST))
def q15_wordcount_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unspaced_word_counts(spark, sf_dir, segment.LIKELIEST)


@register(_dictionary_sql(segment.LONGEST))
def q15_wordcount_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unspaced_word_counts(spark, sf_dir, segment.LONGEST)


_STOP_SQL = f"""
    stop as (select word from ({_sql_tokens("benchmark")}) where length(word) >= 2
             group by word order by count(*) desc, word limit 20)
"""


def _stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = words.word_counts(words.tokenize(table(spark, sf_dir, "benchmark"), "text"))
    return words.top_words(counts, 20).select("word")


@register(
    f"""
    with {_STOP_SQL}
    select word, count(*) as count from ({_sql_tokens("documents")})
    where length(word) >= 2 and word not in (select word from stop) group by word
    """
)
def q16_stopword_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = words.word_counts(words.tokenize(table(spark, sf_dir, "documents"), "text"))
    return words.drop_stop_words(counts, _stop_words(spark, sf_dir))


@register(
    f"""
    with {_STOP_SQL}, tokens as (
        select 'role' as field, * from ({_sql_tokens("conversations", "role")})
        union all select 'text', * from ({_sql_tokens("conversations")})
    ), counts as (
        select field, word, count(*) as count from tokens
        where length(word) >= 2 and word not in (select word from stop) group by 1, 2
    )
    select field, word, count from counts
    qualify row_number() over (partition by field order by count desc, word) <= 300
    """
)
def q16_word_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-weight lists of several text columns of one table; the stop words go through a file."""
    uri = new_folder(spark, "stop_words")
    _stop_words(spark, sf_dir).write.text(uri)
    talks = table(spark, sf_dir, "conversations")
    return report.word_weights(talks, ["role", "text"], tables.read_word_list(spark, uri))


# --- statistics and learning -----------------------------------------------------------------------


@register("select cast(l_linenumber <= 3 as int) as label, count(*) as n from lineitem group by 1")
def q17_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = learning.with_label(table(spark, sf_dir, "lineitem"), "l_linenumber", 3)
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@register(
    """
    select cast(l_linenumber <= 3 as int) as label, cast(sum(l_quantity) as double) as quantity,
           cast(sum(l_linenumber) as double) as lines
    from lineitem group by 1
    """
)
def q17_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = learning.with_label(table(spark, sf_dir, "lineitem"), "l_linenumber", 3)
    vectors = learning.assemble(labelled, ["l_quantity", "l_linenumber"])
    values = vectors.select("label", vector_to_array("features").alias("v"))
    return values.groupBy("label").agg(
        F.sum(F.get("v", 0)).alias("quantity"), F.sum(F.get("v", 1)).alias("lines")
    )


@register(
    "select o_orderkey, substr(md5(cast(o_orderkey as varchar)), 1, 8) < 'cccccccc' as is_train from orders"
)
def q18_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.with_split(table(spark, sf_dir, "orders"), ["o_orderkey"]).select("o_orderkey", "is_train")


@register(
    """
    select substr(md5(cast(o_orderkey as varchar)), 1, 8) < 'cccccccc' as is_train, count(*) as n
    from orders group by 1
    """
)
def q18_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = learning.with_split(table(spark, sf_dir, "orders"), ["o_orderkey"])
    return marked.groupBy("is_train").agg(F.count(F.lit(1)).alias("n"))


def _spearman_sql(features: list[str]) -> str:
    ranks = ", ".join(
        f"rank() over (order by {f}) + (count(*) over (partition by {f}) - 1) / 2.0 as r{i}"
        for i, f in enumerate(features)
    )
    cells = " union all ".join(
        f"select cast({i} as bigint) as i, cast({j} as bigint) as j, '{a}' as feature_i, '{b}' as feature_j, "
        + ("cast(1.0 as double)" if i == j else f"(select corr(r{i}, r{j}) from ranks)")
        + " as value"
        for i, a in enumerate(features)
        for j, b in enumerate(features)
    )
    return f"with ranks as (select {ranks} from lineitem), cells as ({cells})"


@register(_spearman_sql(_LINE_METRICS) + " select i, j, feature_i, feature_j, round(value, 6) as value from cells")
def q19_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = statistics.spearman(table(spark, sf_dir, "lineitem"), _LINE_METRICS)
    return long.withColumn("value", F.round("value", 6))


_WIDE_CELLS = ", ".join(f"round(max(value) filter (feature_j = '{f}'), 6) as {f}" for f in _LINE_METRICS)


@register(_spearman_sql(_LINE_METRICS) + f" select feature_i as feature, {_WIDE_CELLS} from cells group by 1")
def q19_correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = statistics.spearman(table(spark, sf_dir, "lineitem"), _LINE_METRICS)
    wide = statistics.correlation_matrix(long, _LINE_METRICS)
    return wide.select("feature", *[F.round(f, 6).alias(f) for f in _LINE_METRICS])


def _labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with their documents; `doc_id` is unique on both sides."""
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")


@register(
    """
    with scored as (select quality as t, cast(n_chars >= 1000 as int) as p from labels join documents using (doc_id))
    select count(*) filter (t = 1 and p = 1) as tp, count(*) filter (t = 0 and p = 1) as fp,
           count(*) filter (t = 0 and p = 0) as tn, count(*) filter (t = 1 and p = 0) as fn,
           round(avg(cast(t = p as int)), 6) as accuracy
    from scored
    """
)
def q20_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _labelled_documents(spark, sf_dir).select("quality", "n_chars")
    measured = statistics.accuracy(scored, F.col("quality"), F.col("n_chars") >= 1000)
    return measured.withColumn("accuracy", F.round("accuracy", 6))


@register(
    """
    with ranked as (
        select quality, rank() over (order by n_chars) + (count(*) over (partition by n_chars) - 1) / 2.0 as r
        from labels join documents using (doc_id)
    ), sums as (
        select count(*) filter (quality = 1) as p, count(*) filter (quality = 0) as q,
               cast(sum(r) filter (quality = 1) as double) as s
        from ranked
    )
    select p as positives, q as negatives,
           round((s - p * (p + 1) / 2.0) / (cast(p as double) * q), 6) as auc from sums
    """
)
def q21_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _labelled_documents(spark, sf_dir).select("quality", "n_chars")
    # its SQL has no count of skipped rows
    row = statistics.area_under_roc(scored, "quality", "n_chars").drop("skipped")
    return row.withColumn("auc", F.round("auc", 6))


def _share_of_letters(pattern: str) -> Column:
    return F.length(F.regexp_replace("text", pattern, "")) / F.greatest(F.col("n_chars"), F.lit(1))


@register()
def q22_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four classifiers of document quality. No SQL: iterative fitting."""
    features = {
        "chars": F.col("n_chars").cast("double"),
        "lines": F.size(F.split("text", "\n")).cast("double"),
        "words": F.size(F.split("text", r"\s+")).cast("double"),
        "letters": _share_of_letters(r"[^\p{L}]"),
        "digits": _share_of_letters(r"[^\p{N}]"),
        "capitals": _share_of_letters(r"[^\p{Lu}]"),
        "marks": _share_of_letters(r"[^\p{P}]"),
    }
    docs = _labelled_documents(spark, sf_dir)
    values = docs.select(
        "doc_id", (1 - F.col("quality")).alias("miss"), *[value.alias(name) for name, value in features.items()]
    )
    return learning.leaderboard(learning.prepare(values, ["doc_id"], list(features), "miss", 0))


# --- report tables ---------------------------------------------------------------------------------


def _sql_wrap(value: str, every: int) -> str:
    return f"rtrim(regexp_replace({value}, '(?s)(.{{{every}}})', '\\1' || chr(10), 'g'), chr(10))"


@register(
    f"""
    with shown as (select o_custkey, count(o_custkey) as count from orders
                   group by 1 order by count desc, o_custkey limit 10)
    select o_custkey, {_sql_wrap("cast(o_custkey as varchar)", 6)} as label, count,
           round(100.0 * count / sum(count) over (), 2) as percent
    from shown
    """
)
def q23_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.count_page(table(spark, sf_dir, "orders"), "o_custkey")


# Display names with a gap: l_tax has none.
_LINE_NAMES = {"l_quantity": "quantity", "l_extendedprice": "price", "l_discount": "discount"}
_LINE_NAMES_SQL = "case {c} " + " ".join(f"when '{k}' then '{v}'" for k, v in _LINE_NAMES.items()) + " else {c} end"


@register(
    _spearman_sql(_LINE_METRICS)
    + f""" select i, j, {_LINE_NAMES_SQL.format(c="feature_i")} as label_i,
           {_LINE_NAMES_SQL.format(c="feature_j")} as label_j, round(value, 2) as value from cells"""
)
def q24_matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = statistics.spearman(table(spark, sf_dir, "lineitem"), _LINE_METRICS)
    return report.correlation_triples(long, _LINE_NAMES)


@register(
    f"""
    with wide as (
        select p_brand, count(*) as parts, {_MONEY.format(c="p_retailprice")} as price, sum(p_size) as size
        from part group by 1 order by parts desc, p_brand limit 10
    )
    select p_brand, 'Parts' as measure, cast(parts as double) as value from wide
    union all select p_brand, 'Price', round(price, 2) from wide
    union all select p_brand, 'Size', cast(size as double) from wide
    """
)
def q25_series_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-10 table through a headered CSV, then one series per measure."""
    parts = table(spark, sf_dir, "part")
    wide = parts.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum(F.col("p_retailprice").cast("decimal(20,2)")).cast("double").alias("price"),
        F.sum("p_size").alias("size"),
    )
    uri = new_folder(spark, "brands")
    write_result(wide.orderBy(F.col("parts").desc(), "p_brand").limit(10), uri)
    stored = tables.read_result(spark, uri, "p_brand string, parts bigint, price double, size bigint")
    return report.series_long(stored, "p_brand", {"parts": "Parts", "price": "Price", "size": "Size"}, 2)


@register(
    f"select c_custkey, {_sql_wrap("c_name || ' ' || c_mktsegment", 12)} as label from customer"
)
def q26_wrap_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = wrap_text(F.concat_ws(" ", "c_name", "c_mktsegment"), 12)
    return table(spark, sf_dir, "customer").select("c_custkey", label.alias("label"))


def _metric_pages_sql() -> str:
    rows = " union all ".join(
        f"(select '{m}' as metric, 'rows' as series, c_name as name, cast({m} as double) as value, "
        f"row_number() over (order by {m} desc, c_name) as rank from customer)"
        for m in ("c_acctbal", "c_nationkey")
    )
    totals = " union all ".join(
        f"(select '{m}', 'totals', c_mktsegment, total, row_number() over (order by total desc, c_mktsegment) "
        f"from (select c_mktsegment, {_MONEY.format(c=m)} as total from customer group by 1))"
        for m in ("c_acctbal", "c_nationkey")
    )
    return f"""
        select metric, series, cast(rank as bigint) as rank, {_sql_wrap("name", 12)} as label, value
        from ({rows} union all {totals}) where rank <= 10
    """


@register(_metric_pages_sql())
def q26_metric_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return report.metric_pages(customers, ["c_acctbal", "c_nationkey"], "c_name", "c_mktsegment", scale=2)


# Display names with a gap: 5-LOW has none.
_PRIORITY_NAMES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "open"}


@register(
    "select o_orderpriority as code, case o_orderpriority "
    + " ".join(f"when '{k}' then '{v}'" for k, v in _PRIORITY_NAMES.items())
    + " else o_orderpriority end as label, count(*) as n from orders group by 1"
)
def q27_display_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("code", display_name(F.col("code"), _PRIORITY_NAMES).alias("label"), "n")


@register(
    """
    select c_custkey, cast(c_nationkey as bigint) as c_nationkey,
           coalesce(case when n_regionkey > 0 then n_name end, cast(c_nationkey as varchar)) as label
    from customer left join nation on c_nationkey = n_nationkey
    """
)
def q27_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as a table, without those of region 0."""
    nations = table(spark, sf_dir, "nation").where("n_regionkey > 0")
    names = nations.select(F.col("n_nationkey").cast("bigint").alias("c_nationkey"), F.col("n_name").alias("label"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("c_nationkey"))
    return report.lookup_names(customers, names, "c_nationkey", "label").select("c_custkey", "c_nationkey", "label")


@register(
    """
    select l_orderkey, l_linenumber, cast(l_partkey as bigint) as l_partkey,
           coalesce(case when p_size > 5 then p_name end, cast(l_partkey as varchar)) as label
    from lineitem left join part on l_partkey = p_partkey
    """
)
def q27_lookup_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names too many to broadcast: part names of line items, without the small parts."""
    parts = table(spark, sf_dir, "part").where("p_size > 5")
    names = parts.select(F.col("p_partkey").cast("bigint").alias("l_partkey"), F.col("p_name").alias("label"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("bigint").alias("l_partkey"))
    return report.lookup_names(items, names, "l_partkey", "label", broadcast=False)


# --- arrival ---------------------------------------------------------------------------------------


# Batches the documents arrive in, at least.
ARRIVALS = 5


def _arriving(spark: SparkSession, df: DataFrame, key: str) -> DataFrame:
    """A table as a file stream of about ARRIVALS batches."""
    landing = new_folder(spark, "ingest-landing")
    arriving = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // ARRIVALS)
    write_table(df.repartition(ARRIVALS * arriving, key), landing)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", arriving).parquet(landing)


@register("select distinct md5(text) as text_md5, length(text) as n_chars from documents")
def q28_incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as they arrive, keeping the first arrival of each text."""
    stream = _arriving(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    keyed = stream.select(
        digest(F.col("text")).alias("text_key"),
        "doc_id",
        F.md5("text").alias("text_md5"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
    target, checkpoint = new_folder(spark, "ingest"), new_folder(spark, "ingest-checkpoint")
    keep_first_stream(keyed, ["text_key"], ["doc_id"], target, checkpoint).awaitTermination()
    return spark.read.parquet(target).select("text_md5", "n_chars")


@register(ORACLE["q09_clean_documents_audit"])
def q28_ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of documents that arrive in batches is that of the batch job: rows with one key are alike here."""
    stream = _arriving(spark, _noted_documents(spark, sf_dir), "doc_id")
    target, checkpoint, audit = (new_folder(spark, f"ingest-{x}") for x in ("clean", "checkpoint", "audit"))
    clean_stream(stream, _DOCUMENT_RULES, target, checkpoint, audit_uri=audit).awaitTermination()
    return audited(spark, audit, _DOCUMENT_RULES)


@register("select distinct user_id, event_type from events")
def q28_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as they arrive, the first of each user and type within a time longer than all events take."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    target, checkpoint = new_folder(spark, "event-time"), new_folder(spark, "event-time-checkpoint")
    stream = _arriving(spark, events, "event_id")
    first_within_stream(stream, ["user_id", "event_type"], "ts", "10000 days", target, checkpoint).awaitTermination()
    return spark.read.parquet(target).select("user_id", "event_type")


_ARRIVING_RULES = replace(_DOCUMENT_RULES, text=["text"], fill={}, output=["lang", "n_chars", "text"])
_ARRIVING_RANKINGS = [
    rankings.group_counts("lengths", "n_chars", 10),
    rankings.group_sums("languages", "lang", ["n_chars"], 10),
    rankings.best_rows("longest", ["text"], ["n_chars"], 10),
    rankings.word_totals("words", ["text"], 50),
]


@register(
    f"""
    with firsts as (select distinct lang, text, n_chars from documents where n_chars > 0 and n_chars <= 5000),
    tokens as ({_sql_tokens("firsts")}),
    lengths as (select n_chars, count(*) as n from firsts group by 1),
    languages as (select lang, cast(sum(n_chars) as bigint) as n from firsts group by 1),
    words as (select word, count(*) as n from tokens where length(word) >= 2 group by 1)
    (select 'lengths' as ranking, cast(n_chars as varchar) as name, n as value from lengths order by n desc, n_chars limit 10)
    union all (select 'languages', lang, n from languages order by n desc, lang limit 10)
    union all (select 'longest', md5({_sql_clean("text")}), n_chars from firsts order by n_chars desc, {_sql_clean("text")} limit 10)
    union all (select 'words', word, n from words order by n desc, word limit 50)
    """
)
def q29_rankings_on_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rankings of documents that arrive in batches, from what each batch contributed."""
    stream = _arriving(spark, table(spark, sf_dir, "documents"), "doc_id")
    target, checkpoint, own = (new_folder(spark, f"rankings-{x}") for x in ("clean", "checkpoint", "runs"))
    clean_stream(stream, _ARRIVING_RULES, target, checkpoint, rankings=_ARRIVING_RANKINGS, rankings_uri=own).awaitTermination()
    lengths, languages, longest, most = (rankings.current(spark, own, x) for x in _ARRIVING_RANKINGS)
    parts = [
        ("lengths", lengths, F.col("n_chars").cast("string"), "count"),
        ("languages", languages, F.col("lang"), "total"),
        ("longest", longest, F.md5("text"), "value"),
        ("words", most, F.col("word"), "count"),
    ]
    out = [rows.select(F.lit(name).alias("ranking"), key.alias("name"), F.col(value).cast("bigint").alias("value")) for name, rows, key, value in parts]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])
