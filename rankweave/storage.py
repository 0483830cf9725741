"""Shared scratch folders, checks of table size, and the package itself for the executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may have to be sent to every executor. Checked by counting, never assumed.
BROADCAST_ROWS = 100_000
# Bytes such a side may have, its values written as text.
BROADCAST_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: `spark.checkpoint.dir` of the session.

    Only a local master may fall back to the session's warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return spark.conf.get("spark.sql.warehouse.dir")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/rankweave/{purpose}-{uuid.uuid4().hex}"


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """True when `df` has at most `limit` rows of at most `most_bytes` as text. Reads no further than it needs to."""
    lengths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("bigint") for c in df.columns]
    width = sum(lengths[1:], lengths[0])
    seen = df.select(width.alias("width")).limit(limit + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum("width"), F.lit(0))).first()
    return seen[0] <= limit and seen[1] <= most_bytes


_given: set[str] = set()


def give_package(spark: SparkSession) -> None:
    """Let the Python workers of this session import the package, wherever they run; once for each application.

    Spark's driver serves the archive to the executors. Nothing is done where the package was itself loaded from an
    archive, as with `--py-files`: that one is there already.
    """
    package, context = Path(__file__).resolve().parent, spark.sparkContext
    if context.applicationId in _given or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _given.add(context.applicationId)


def _at(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def names_below(spark: SparkSession, uri: str) -> list[str]:
    """Names of what lies directly below a folder; none where there is no folder."""
    files, path = _at(spark, uri)
    return [entry.getPath().getName() for entry in files.listStatus(path)] if files.exists(path) else []


def remove(spark: SparkSession, uri: str) -> None:
    files, path = _at(spark, uri)
    files.delete(path, True)


def rename(spark: SparkSession, uri: str, to: str) -> None:
    files, path = _at(spark, uri)
    if not files.rename(path, _at(spark, to)[1]):
        raise OSError(f"cannot rename {uri} to {to}")


def read_note(spark: SparkSession, uri: str) -> str:
    """A file of a few lines, read by the driver."""
    files, path = _at(spark, uri)
    content = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(content, "UTF-8")
    finally:
        content.close()


def write_note(spark: SparkSession, uri: str, text: str) -> None:
    """A file of a few lines, which is there whole or not at all: written beside its place and renamed."""
    files, path = _at(spark, uri)
    _, beside = _at(spark, f"{uri}.{uuid.uuid4().hex}.tmp")
    out = files.create(beside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    files.delete(path, False)
    if not files.rename(beside, path):
        raise OSError(f"cannot write {uri}")
