"""JSON envelopes: one document per issue, a header and an array of items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions.numeric import once
from rankweave.schemas import BEST_RANK, DISLIKE, ENVELOPE, METRICS

_END = "end"
# Bytes of a file that is read as one document, at most.
MOST_BYTES = 256 << 20
_FILE = "path string, modificationTime timestamp, length bigint, content binary"

# Why a document is refused.
EMPTY = "empty"
TOO_LARGE = "too_large"
UNDECODABLE = "undecodable"
UNPARSEABLE = "unparseable"
NULL_ITEM = "null_item"


def parse_json(df: DataFrame, payload: str, schema: T.StructType | str, out: str = "doc") -> DataFrame:
    """Add the parsed document `out` and the flag `is_valid`.

    A payload is valid when it is exactly one JSON object that fits the schema. `from_json` alone
    stops after the first object and would take `{"a":1} trailing text`; so the payload is set into a
    one-element array with an end mark after it, and both have to come back.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    wrapped = T.StructType(
        [
            T.StructField("d", T.ArrayType(schema)),
            T.StructField("e", T.StringType()),
            T.StructField("_corrupt", T.StringType()),
        ]
    )
    options = {"columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}
    text = F.concat(F.lit('{"d":['), F.col(payload), F.lit(f'],"e":"{_END}"}}'))
    parsed = df.select("*", once(F.from_json(text, wrapped, options)).alias("_parsed"))
    whole = (
        F.col("_parsed._corrupt").isNull()
        & (F.col("_parsed.e") == _END)
        & (F.size("_parsed.d") == 1)
        & F.get("_parsed.d", 0).isNotNull()
    )
    return parsed.select(
        *df.columns,
        F.get("_parsed.d", 0).alias(out),
        F.coalesce(whole, F.lit(False)).alias("is_valid"),
    )


def read_payloads(spark: SparkSession, uri: str, one_per_file: bool = True, most_bytes: int = MOST_BYTES) -> DataFrame:
    """`(file_name, file_path, payload, fault)` for each file, or for each line of each file.

    Files are read as bytes, so that `parse_payloads` can tell those that are no UTF-8. `fault` says why a file
    has no payload: it is empty, or larger than `most_bytes` and then never read; a line has none. Lines of one file
    share its name; cleaning needs a name per document, so take it from the payload there.
    """
    if not one_per_file:
        return _named(spark.read.text(uri), F.col("value"), F.lit(None).cast("string"))
    files = spark.read.format("binaryFile").load(uri)
    large = _named(files.where(F.col("length") > most_bytes), F.lit(None).cast("string"), F.lit(TOO_LARGE))
    whole = _named(files.where(F.col("length") <= most_bytes), F.col("content").cast("string"), F.lit(None).cast("string"))
    empty = empty_files(spark, uri).select("*", F.lit(None).cast("string").alias("payload"), F.lit(EMPTY).alias("fault"))
    return whole.unionByName(large).unionByName(empty)


def empty_files(spark: SparkSession, uri: str) -> DataFrame:
    """`(file_name, file_path)` of files of zero bytes, which every file source of Spark passes over.

    They are the files that the driver listed and that no task was given. The driver holds the names of all
    files to plan any scan of them; no content is read.
    """
    files = spark.read.format("binaryFile").load(uri)
    listed = spark.createDataFrame([(path,) for path in files.inputFiles()], "path string").select(_location("path").alias("file_path"))
    given = files.select(_location("_metadata.file_path").alias("given"))
    empty = listed.join(given, F.col("file_path") == F.col("given"), "left_anti")
    return empty.select(_spelled(F.element_at(F.split("file_path", "/"), -1)).alias("file_name"), "file_path")


def stream_payloads(
    spark: SparkSession, uri: str, one_per_file: bool = True, files_per_batch: int | None = None, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """Streaming form of `read_payloads`; a stream is never given an empty file, see `empty_files` for those."""
    reader = spark.readStream.format("binaryFile").schema(_FILE) if one_per_file else spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if not one_per_file:
        return _named(reader.load(uri), F.col("value"), F.lit(None).cast("string"))
    small = F.col("length") <= most_bytes
    return _named(reader.load(uri), F.when(small, F.col("content").cast("string")), F.when(~small, F.lit(TOO_LARGE)))


def _location(path: str) -> Column:
    """A path with one slash after its scheme, as listings and scans write it differently."""
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _spelled(name: Column) -> Column:
    """A file's name from its form in a path, which is that of a URL, but for a plus sign."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _named(files: DataFrame, payload: Column, fault: Column) -> DataFrame:
    return files.select(
        _spelled(F.col("_metadata.file_name")).alias("file_name"),
        _location("_metadata.file_path").alias("file_path"),
        payload.alias("payload"),
        fault.alias("fault"),
    )


def parse_payloads(df: DataFrame, payload: str = "payload", schema: T.StructType = ENVELOPE) -> DataFrame:
    """Documents with `doc`, and `payload` and `reason` where one is refused.

    A document with an unusable item is refused as a whole, like one that does not parse or holds a byte that
    is no UTF-8: nothing is repaired. A refused payload stays as it came, byte for byte. Write this once
    and take `accepted` and `refused` from it, to parse each document once.
    """
    fault = F.col("fault") if "fault" in df.columns else F.lit(None).cast("string")
    others = [name for name in df.columns if name not in (payload, "fault")]
    decoded = F.is_valid_utf8(F.col(payload))
    held = df.select(*others, F.col(payload).alias("_raw"), fault.alias("_fault"), F.when(decoded, F.col(payload)).alias("_text"))
    parsed = parse_json(held, "_text", schema)
    reason = (
        F.when(F.col("_fault").isNotNull(), F.col("_fault"))
        .when(F.col("_raw").isNotNull() & F.col("_text").isNull(), UNDECODABLE)
        .when(~F.col("is_valid"), UNPARSEABLE)
        .when(F.exists("doc.data.list", lambda item: item.isNull()), NULL_ITEM)
    )
    kept = parsed.select(*others, "doc", "_raw", reason.alias("reason"))
    return kept.select(
        *others,
        F.when(F.col("reason").isNull(), F.col("doc")).alias("doc"),
        F.when(F.col("reason").isNotNull(), F.col("_raw")).alias(payload),
        "reason",
    )


def accepted(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """Documents that can be used, as `doc`."""
    return documents.where("reason is null").drop(payload, "reason")


def refused(documents: DataFrame) -> DataFrame:
    """Quarantine: documents that cannot be used, as they came, with the reason."""
    return documents.where("reason is not null").drop("doc")


def split_payloads(
    df: DataFrame, payload: str = "payload", schema: T.StructType = ENVELOPE
) -> tuple[DataFrame, DataFrame]:
    """Accepted documents and quarantine of a table of payloads."""
    documents = parse_payloads(df, payload, schema)
    return accepted(documents, payload), refused(documents)


def explode_items(docs: DataFrame, items: Column | str, **keep: Column) -> DataFrame:
    """One row `(*keep, pos, item)` per array element.

    What is kept is taken out of the document first, or every row would carry the whole document.
    """
    array = F.col(items) if isinstance(items, str) else items
    flat = docs.select(*[value.alias(name) for name, value in keep.items()], array.alias("_items"))
    return flat.select(*keep, F.posexplode("_items").alias("pos", "item"))


def envelope_records(docs: DataFrame, **also: Column) -> DataFrame:
    """Accepted documents to raw records, one per item, values still as text, with columns `also` of the document.

    Documents read from files also have the path, which tells files of equal name apart.
    """
    places = [name for name in ("file_name", "file_path") if name in docs.columns]
    items = explode_items(
        docs,
        "doc.data.list",
        **{name: F.col(name) for name in places},
        period=F.coalesce(F.col("doc.data.config.name"), F.lit("")),
        **also,
    )
    return items.select(
        *places,
        *also,
        "pos",
        "period",
        F.col("item.owner.name").alias("up"),
        "item.title",
        "item.tname",
        *[F.col(f"item.stat.{name}").alias(name) for name in (*METRICS, BEST_RANK, DISLIKE)],
        "item.desc",
        "item.rcmd_reason",
    )


def documents_without_items(docs: DataFrame) -> DataFrame:
    """Accepted documents whose list is missing or null; they give no record, so they are named here."""
    places = [name for name in ("file_name", "file_path") if name in docs.columns]
    return docs.where(F.col("doc.data.list").isNull()).select(*places)
