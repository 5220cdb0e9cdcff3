"""The first row of every key of a table that grows, kept from run to run.

A snapshot flow asks for the first good row per key of all of bronze. Bronze only gains files, so that row is the first of
the one known so far and of the new files' rows: a run reads the stored rows and the files it has not merged yet, not
bronze again. Each step that merged something has a place:

``place=P/rows`` (the first rows), ``place=P/files`` (names of all files merged so far), and ``_log/P.json``, which publishes
the step. A step that is not in the log does not exist; a failed one is repeated under its place. ``_used/P-*.json``
says that the history has taken the step. The last two steps are kept, so a reader of the one before is not disturbed.

Bronze is read as a whole where this does not hold: at first, where keys, order or other plan differ from the last step's,
and where a file that was merged is no longer there (a replaced table). File names pass through the driver, as they do in
Spark's own listing; rows do not. Files are told apart by name, since Spark never writes one name twice. One writer is assumed.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from .operators import dedup
from .operators.ordering import OrderKey
from .schemas import fitted
from .sources.tables import read_table
from .storage import exists, file_names, list_folders, read_small, remove_folder, write_small
from .streaming.cdc_stream import plain_rows


@dataclass
class Step:
    """What a run finds: its place, the first rows with everything merged, the bronze rows not merged before (None: there are
    none, and the rows are the stored ones), all file names, and whether all of bronze is read."""

    place: int
    rows: DataFrame
    new: DataFrame | None
    files: list[str]
    whole: bool


class FirstRows:
    """Stored first rows per key (in ``order_keys`` order, ties by the remaining columns) of the good rows of a bronze folder.
    ``plan`` is whatever else must stay the same for the stored rows to be used."""

    def __init__(
        self, spark: SparkSession, root: str, table: str, keys: Sequence[str], order_keys: Iterable[OrderKey], plan: Any = None,
    ):
        self.spark, self.root, self.table = spark, root.rstrip("/"), table
        self.keys, self.order_keys = list(keys), list(order_keys)
        self.mark = hashlib.md5(repr((table, self.keys, self.order_keys, plan)).encode()).hexdigest()

    def _last(self) -> dict | None:
        known = [name for name in file_names(self.spark, f"{self.root}/_log") if name.endswith(".json") and name[0] != "."]
        return json.loads(read_small(self.spark, f"{self.root}/_log/{known[-1]}")) if known else None

    def _folder(self, place: int) -> str:
        return f"{self.root}/place={place:06}"

    def _stored(self, place: int) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder(place)}/rows")

    def _first(self, rows: DataFrame) -> DataFrame:
        return dedup.first_per_key(rows, self.keys, self.order_keys)

    def step(self) -> Step:
        """The next step, as a plan: nothing is written."""
        bronze = read_table(self.spark, self.table)
        names, last = sorted(bronze.inputFiles()), self._last()
        place = 0 if last is None else last["place"] + 1
        if last is not None and last["mark"] == self.mark:
            merged = {r.file for r in self.spark.read.parquet(f"{self._folder(last['place'])}/files").collect()}
            if merged.issubset(names):
                schema = plain_rows(bronze).schema
                kept = fitted(self._stored(last["place"]), schema)  # bronze may have gained or widened columns since
                fresh = [unquote(name) for name in names if name not in merged]
                if not fresh:
                    return Step(last["place"], kept, None, names, False)
                new = self.spark.read.schema(bronze.schema).option("basePath", self.table).parquet(*fresh)
                return Step(place, self._first(kept.unionByName(plain_rows(new))), new, names, False)
        return Step(place, self._first(plain_rows(bronze)), bronze, names, True)

    def publish(self, step: Step) -> DataFrame:
        """Store the step (unless it has merged nothing) and return its rows as stored."""
        if step.new is None:
            return step.rows
        here = self._folder(step.place)
        step.rows.write.mode("overwrite").parquet(f"{here}/rows")
        self.spark.createDataFrame([(name,) for name in step.files], "file string").coalesce(1).write.mode("overwrite").parquet(f"{here}/files")
        write_small(self.spark, f"{self.root}/_log/{step.place:06}.json", json.dumps({"place": step.place, "mark": self.mark}))
        for name in list_folders(self.spark, self.root):
            if int(name.partition("=")[2]) < step.place - 1:
                remove_folder(self.spark, f"{self.root}/{name}")
        return self._stored(step.place)

    def _use(self, step: Step) -> str:
        columns = hashlib.md5(step.rows.schema.simpleString().encode()).hexdigest()[:12]
        return f"{self.root}/_used/{step.place:06}-{columns}.json"

    def used(self, step: Step) -> bool:
        """Whether the history has taken the step's rows, under the columns they have now."""
        return step.new is None and exists(self.spark, self._use(step))

    def mark_used(self, step: Step) -> None:
        if not exists(self.spark, self._use(step)):
            write_small(self.spark, self._use(step), "{}")
