"""What a stream has written so far, as a few runs instead of one folder for each batch.

Every batch adds a run. Whenever FAN runs of one level exist they are merged into one of the next level, so after n
batches about (FAN - 1) * log(n) runs are read, and a row is merged once for each level. Which runs are valid after a
batch says a note that the batch writes last, in one step. A batch reads the note of the one before it and never
changes what that note names: one that is killed, or run again, starts from the same runs and writes the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rankweave.sinks import write_table
from rankweave.storage import names_below, read_note, remove, write_note

# Runs of one level that are merged.
FAN = 4
BATCH = "batch_id"


class Runs:
    """The runs below `uri`. `schema` has the columns that are read, if not all; `merge` may make rows of several runs fewer."""

    def __init__(self, spark: SparkSession, uri: str, schema: StructType | None, merge: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.uri, self.schema = spark, uri.rstrip("/"), schema
        self.merge = merge or (lambda rows: rows)

    def folder(self, name: str) -> str:
        return f"{self.uri}/{name}"

    def own(self, batch_id: int, level: int = 0) -> str:
        """The name of a run that only this class reads; it is removed when no note names it any more."""
        return f"_runs/{batch_id}-{level}"

    def _noted(self) -> list[int]:
        return [int(name) for name in names_below(self.spark, self.folder("_notes")) if name.isdigit()]

    def _note(self, batch_id: int) -> list[tuple[int, str]]:
        lines = read_note(self.spark, self.folder(f"_notes/{batch_id}")).splitlines()
        return [(int(level), name) for level, name in (line.split(" ", 1) for line in lines)]

    def before(self, batch_id: int | None = None) -> list[tuple[int, str]]:
        """(level, name) of the runs valid before a batch, or now. Later notes may exist when an old batch is replayed."""
        earlier = [x for x in self._noted() if batch_id is None or x < batch_id]
        return self._note(max(earlier)) if earlier else []

    def read(self, runs: list[tuple[int, str]]) -> DataFrame | None:
        """Rows of these runs."""
        if not runs:
            return None
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(*[self.folder(name) for _, name in runs])

    def add(self, batch_id: int, name: str) -> None:
        """Add a written folder as the run of a batch, merge what is due, and make both valid."""
        runs = [*self.before(batch_id), (0, name)]
        level = 0
        while any(own >= level for own, _ in runs):
            due = [run for run in runs if run[0] == level]
            if len(due) >= FAN:
                merged = self.own(batch_id, level + 1)
                write_table(self.merge(self.read(due)).hint("rebalance"), self.folder(merged))
                runs = [run for run in runs if run[0] != level] + [(level + 1, merged)]
            level += 1
        write_note(self.spark, self.folder(f"_notes/{batch_id}"), "".join(f"{own} {run}\n" for own, run in runs))
        self._forget(batch_id)

    def _forget(self, batch_id: int) -> None:
        """Remove notes before the last one that a replay of this batch reads, and the runs that only they name."""
        noted = self._noted()
        needed = max([x for x in noted if x < batch_id], default=batch_id)
        for old in [x for x in noted if x < needed]:
            remove(self.spark, self.folder(f"_notes/{old}"))
        named = {name for x in noted if x >= needed for _, name in self._note(x)}
        for run in names_below(self.spark, self.folder("_runs")):
            if f"_runs/{run}" not in named and int(run.split("-")[0]) <= batch_id:
                remove(self.spark, self.folder(f"_runs/{run}"))
