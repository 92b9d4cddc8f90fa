"""Stored tables: Parquet in run folders, visible once a run is committed.

A run writes its tables to a folder of its own. Committing it puts one file with the next number into the log
in ``runs``, created only if that number is still free: of two writers that saw the same state one gets it and the other
learns of the conflict. A commit lists the folders that make up each table, so a run may add to the tables
of the run before without writing them again, and carries notes, such as what it was made from. Readers follow the last
commit; a failed or unfinished run is never seen, and a refresh needs no truncation. Committing removes what the last
``keep`` commits do not use.

The file system must create a file only if it is absent, as HDFS and local folders do; object stores need a committer that does.
"""

from __future__ import annotations

import datetime
import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Conflict(Exception):
    """Another writer committed first."""


@dataclass(frozen=True)
class Commit:
    number: int
    run: str
    parts: dict[str, list[str]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


class Store:
    """Tables under ``root``, by kind (``staging``, ``star`` or ``marts``) and run."""

    def __init__(self, spark: SparkSession, root: str, kind: str, keep: int = 2):
        self.spark = spark
        self._base = f"{root}/{kind}"
        self._keep = keep
        self._open: dict[str, dict[str, list[str]]] = {}

    def new_run(self, after: Commit | None = None) -> str:
        """A run name; later runs sort after earlier ones. The tables of ``after`` are part of the new run."""
        now = datetime.datetime.now(datetime.timezone.utc)
        run = f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        self._open[run] = {name: list(parts) for name, parts in after.parts.items()} if after else {}
        return run

    def write(self, df: DataFrame, run: str, name: str, order: tuple[str, ...] = (), by: tuple[str, ...] = (), replace: bool = False, options: dict | None = None) -> int:
        """Write a table, or what a run adds to it, from the executors in one execution; returns the rows written.

        ``by`` lays it out in folders by value. ``replace`` drops what earlier runs wrote of it. ``options`` are those of the Parquet writer.
        """
        if order:
            df = df.sortWithinPartitions(*order)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.options(**(options or {})).partitionBy(*by).parquet(f"{self._base}/{run}/{name}")
        parts = self._open.setdefault(run, {})
        parts[name] = [*([] if replace else parts.get(name, [])), f"{run}/{name}"]
        return seen.get["rows"]

    def read(self, run: str, name: str, schema: StructType) -> DataFrame:
        """A table of a run, committed or still being written."""
        commit = None if run in self._open else self.commit()
        parts = self._open[run] if commit is None else commit.parts if commit.run == run else self._commit_of(run).parts
        return self.read_parts(parts.get(name, [f"{run}/{name}"]), schema)

    def read_parts(self, parts: list[str], schema: StructType) -> DataFrame:
        """The rows of some folders, each read with its own layout; of the columns that name folders only those in ``schema``."""
        if not parts:
            return self.spark.createDataFrame([], schema)
        out = None
        for part in parts:
            rows = self.spark.read.schema(schema).parquet(f"{self._base}/{part}").select(*schema.names)
            out = rows if out is None else out.unionByName(rows)
        return out

    def parts(self, run: str, name: str) -> list[str]:
        return list(self._open[run].get(name, [])) if run in self._open else list(self._commit_of(run).parts.get(name, []))

    def publish(self, run: str, after: Commit | None = None, notes: dict | None = None) -> Commit:
        """Commit a run. One that builds on ``after`` fails if another commit came in between; any other takes the next number."""
        while True:
            number = (after.number if after else self._last()) + 1
            commit = Commit(number, run, self._open.get(run, {}), notes or {})
            if self._put(commit):
                self._forget()
                return commit
            if after:
                raise Conflict(f"{self._base}: commit {number} exists")

    def commit(self) -> Commit:
        """The last commit."""
        number = self._last()
        if not number:
            raise ValueError(f"PATH_NOT_FOUND: nothing published under {self._base}")
        return self._get(number)

    def before(self, commit: Commit) -> Commit | None:
        """The commit before, if it is still kept."""
        return next((self._get(n) for n in reversed(self._numbers()) if n < commit.number), None)

    def last_commit(self) -> Commit | None:
        return self.commit() if self._last() else None

    def latest(self) -> str:
        return self.commit().run

    def _commit_of(self, run: str) -> Commit:
        for number in self._numbers():
            if (commit := self._get(number)).run == run:
                return commit
        return Commit(0, run)

    # --- the log ---

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self._base, *names]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        files, log = self._files(), self._path("runs")
        if not files.exists(log):
            return []
        names = [entry.getPath().getName() for entry in files.listStatus(log)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def _last(self) -> int:
        """Number of the last readable commit; one that is just being written does not count yet."""
        return next((n for n in reversed(self._numbers()) if self._get(n)), 0)

    def _put(self, commit: Commit) -> bool:
        text = json.dumps({"run": commit.run, "parts": commit.parts, "notes": commit.notes}) + "\n"
        try:
            out = self._files().create(self._path("runs", f"{commit.number:012d}.json"), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _get(self, number: int) -> Commit | None:
        stream = self._files().open(self._path("runs", f"{number:012d}.json"))
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return Commit(number, **json.loads(text)) if text.endswith("\n") else None

    def _forget(self) -> None:
        """Remove what the last commits do not use, and unfinished runs that are older than those."""
        numbers = self._numbers()
        kept = [c for c in map(self._get, numbers[-self._keep :]) if c]
        if len(kept) < self._keep:
            return
        used = {part.split("/")[0] for c in kept for parts in c.parts.values() for part in parts} | {c.run for c in kept}
        files = self._files()
        for entry in files.listStatus(self._path()):
            name = entry.getPath().getName()
            if name != "runs" and name not in used and name < min(c.run for c in kept):
                files.delete(entry.getPath(), True)
        for number in numbers[: -self._keep]:
            files.delete(self._path("runs", f"{number:012d}.json"), False)
