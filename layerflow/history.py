"""Histories of snapshot-fed tables, kept as runs."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .operators import snapshot
from .operators.cdc import END_AT, START_AT
from .schemas import evolve, fitted, read_stored
from .storage import exists, move_folder, remove_folder


@dataclass
class SnapshotStore:
    """History of a snapshot-fed table that is only ever added to.

    ``open/run=R`` holds the rows that are open after run R, ``closed/run=R`` those that R closed; ``log`` has one row
    for each run that is complete, with its place in the order and its version as Spark wrote it. What is not in the
    log does not exist: a run that failed half-way leaves nothing behind, and no folder is written twice. All folders are
    read under the newest schema of the whole table (``schemas``), so runs may add and widen columns.
    """

    spark: SparkSession
    root: str

    def _log(self) -> DataFrame | None:
        path = f"{self.root}/log"
        return self.spark.read.parquet(path) if exists(self.spark, path) else None

    def last(self) -> tuple[int, str, Any] | None:
        """(place, run, version) of the newest complete run."""
        log = self._log()
        row = None if log is None else log.orderBy(F.desc("place")).select("place", "run", "version").first()
        return None if row is None else (row["place"], row["run"], row["version"])

    def folders(self) -> list[str]:
        """Where the rows are: open rows of the newest run, closed rows of all complete ones."""
        last = self.last()
        if last is None:
            return []
        runs = dict.fromkeys(r.run for r in self._log().orderBy("place").select("run").collect())  # repeated versions share a run
        closed = [f"{self.root}/closed/run={run}" for run in runs]
        return [f"{self.root}/open/run={last[1]}", *(path for path in closed if exists(self.spark, path))]

    def open_rows(self) -> DataFrame | None:
        last = self.last()
        return None if last is None else read_stored(self.spark, f"{self.root}/open/run={last[1]}", table=self.root)

    def read(self) -> DataFrame | None:
        """The whole history."""
        found = self.folders()
        return read_stored(self.spark, *found, table=self.root) if found else None

    def add(self, open_rows: DataFrame, closed_rows: DataFrame | None, version: Any) -> None:
        """One more complete run of separate open and closed rows."""
        run = uuid.uuid4().hex
        schema = evolve(self.spark, self.root, open_rows.schema)
        open_rows = fitted(open_rows, schema)
        closed_rows = None if closed_rows is None else fitted(closed_rows, schema)
        open_rows.write.parquet(f"{self.root}/open/run={run}")
        if closed_rows is not None:
            closed_rows.write.parquet(f"{self.root}/closed/run={run}")
        self._log_run(run, version)

    def add_changes(self, changed: DataFrame, version: Any) -> None:
        """One more complete run of rows that are open (no ``__END_AT``) or closed by it. They are computed and written once,
        into a stage of two parts that then become the run's folders."""
        run, stage = uuid.uuid4().hex, f"{self.root}/stage/{uuid.uuid4().hex}"
        schema = evolve(self.spark, self.root, changed.schema)
        fitted(changed, schema).withColumn("__closed", F.col("__END_AT").isNotNull()).write.partitionBy("__closed").parquet(stage)
        for kind, part in (("open", f"{stage}/__closed=false"), ("closed", f"{stage}/__closed=true")):
            if exists(self.spark, part):
                move_folder(self.spark, part, f"{self.root}/{kind}/run={run}")
            else:
                self.spark.createDataFrame([], schema).write.parquet(f"{self.root}/{kind}/run={run}")
        self._log_run(run, version)
        remove_folder(self.spark, stage)

    def repeat(self, version: Any) -> None:
        """A newer version whose snapshot is the last one again: a row of the log, no others."""
        self._log_run(self.last()[1], version)

    def _log_run(self, run: str, version: Any) -> None:
        last = self.last()
        self.spark.range(1).select(
            F.lit(0 if last is None else last[0] + 1).cast("long").alias("place"), F.lit(run).alias("run"),
            F.lit(version).alias("version"), F.current_timestamp().alias("applied_at"),
        ).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def apply(
        self, rows: DataFrame, version: Any, keys: list[str], track: list[str] | None = None, track_except: list[str] | None = None,
        scd_type: int = 2,
    ) -> bool:
        """Apply the whole snapshot ``rows`` taken at ``version``; False if that is not newer than the last one applied, which
        changes nothing for either SCD type. Type 1 keeps the rows of the newest snapshot."""
        last = self.last()
        if last is not None and version <= last[2]:
            return False
        if int(scd_type) == 1:
            self.add(rows, None, version)
        elif last is None:
            self.add(snapshot.apply_snapshot(None, rows, version, keys, track, track_except), None, version)
        else:
            schema = evolve(self.spark, self.root, rows.schema)  # columns new to the table are NULL in its open rows, and the other way
            rows = fitted(rows, StructType([f for f in schema if f.name not in (START_AT, END_AT)]))
            self.add_changes(snapshot.diff_snapshot(self.open_rows(), rows, version, keys, track, track_except), version)
        return True
