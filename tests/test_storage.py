from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from rankweave import sinks, storage


def test_scratch_folders_are_below_the_session_setting(spark):
    first, second = (storage.new_folder(spark, "x") for _ in range(2))
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/")


class Session:
    """Stands for a session without the setting."""

    def __init__(self, master):
        self.conf, self.sparkContext, self.master = self, self, master
        self.settings = {}

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value

    def getCheckpointDir(self):
        return None


def test_only_a_local_master_may_use_a_folder_of_the_machine():
    local = Session("local[2]")
    local.settings["spark.sql.warehouse.dir"] = "file:/w"
    assert storage.shared_folder(local) == "file:/w"
    assert set(local.settings) == {"spark.sql.warehouse.dir"}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session("yarn"))


@pytest.mark.parametrize(("limit", "fits"), [(9, False), (10, True), (11, True)])
def test_fits_broadcast_counts(spark, limit, fits):
    assert storage.fits_broadcast(spark.range(10), limit) is fits


def test_workers_import_the_package_from_anywhere(tmp_path):
    """A session of its own, whose workers know neither the repository nor its path."""
    repository = Path(__file__).resolve().parents[1]
    script = f"""
import sys
sys.path.insert(0, {str(repository)!r})
from pyspark.sql import SparkSession
import __spark_entry__
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
__spark_entry__.give_package(spark)
__spark_entry__.give_package(spark)
sys.path.remove({str(repository)!r})

def names(batches):
    import rankweave.functions.text as module
    for batch in batches:
        batch["id"] = len(module.__name__)
        yield batch

print("found", spark.range(1).mapInPandas(names, "id long").first()[0])
"""
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=200)
    assert "found 24" in run.stdout, run.stderr[-2000:]


def parted(spark, n, fails=False):
    """Rows of two tasks; the second one may fail after the first has written."""
    value = F.when((F.col("id") == n - 1) & F.lit(fails), F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string"))
    return spark.range(n, numPartitions=2).select(value.cast("string").alias("v"))


@pytest.mark.parametrize("write", [sinks.write_table, sinks.write_tsv, sinks.write_result])
def test_a_failing_write_leaves_the_old_result(spark, tmp_path, write):
    uri = str(tmp_path / "out" / "result")
    with pytest.raises(Exception, match="lost"):
        write(parted(spark, 8, fails=True), uri)
    assert not (tmp_path / "out" / "result").exists()
    write(parted(spark, 8), uri)
    read = spark.read.parquet if write is sinks.write_table else spark.read.text
    before = sorted(r[0] for r in read(uri).collect())
    with pytest.raises(Exception, match="lost"):
        write(parted(spark, 30, fails=True), uri)
    assert sorted(r[0] for r in read(uri).collect()) == before
    write(parted(spark, 30), uri)
    assert read(uri).count() == 30 + (write is sinks.write_result)
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")] == ["result"]


def test_a_result_can_be_replaced_by_one_made_from_it(spark, tmp_path):
    uri = str(tmp_path / "table")
    sinks.write_table(spark.range(10), uri)
    sinks.write_table(spark.read.parquet(uri).where("id < 4"), uri)
    assert spark.read.parquet(uri).count() == 4


def test_a_replacement_that_stopped_half_way_is_undone(spark, tmp_path, monkeypatch):
    uri = str(tmp_path / "table")
    sinks.write_table(spark.range(10), uri)
    done = []

    def once(spark, old, new):
        if done:
            raise KeyboardInterrupt
        done.append(storage.rename(spark, old, new))

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "rename", once)
        with pytest.raises(KeyboardInterrupt):
            sinks.write_table(spark.range(3), uri)
    sinks.restore(spark, uri)
    assert spark.read.parquet(uri).count() == 10
    sinks.write_table(spark.range(3), uri)
    assert spark.read.parquet(uri).count() == 3
