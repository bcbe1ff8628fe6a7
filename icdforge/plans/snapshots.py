"""A versioned store for a dimension table: every table action is one commit.

Layout of a store's folder::

    data/<load>/ICD_Version=9/CMS_Fiscal_Year=2012/*.parquet   never changed
    _snapshots/0000000007.json                                  one per commit

A snapshot record is small: per release the folders that hold its rows, its row
count, its fingerprint (:func:`icdforge.operators.history.release_fingerprints`) and
the file it was loaded from, and the table's columns.  Readers follow the record with the highest number, so
they see the table before a load or after it, never between; a reader that has
begun goes on with its own record's files.

A load writes its rows into a folder of its own (Spark's job commit), then
creates the next record: written beside and renamed without overwriting, which
fails if another load has taken the number (:class:`ConcurrentLoad`; nothing has
changed then).  The rename is atomic where the file system's is (HDFS, ABFS); on
a plain disk two loads within the same instant are told apart by the check that
precedes it.  A failed load leaves a folder that no record names; nothing has to
be repaired, :meth:`SnapshotStore.vacuum` removes it.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.history import release_fingerprints
from ..operators.tables import TableSpec
from . import sinks

#: the table actions, and the replacement of the releases that a load brings
ACTIONS = (*sinks.ACTIONS, "REFRESH")
FINGERPRINT = ("Sum_1", "Sum_2", "Sum_3", "Sum_4")


class ConcurrentLoad(RuntimeError):
    """Another load has published since this one began."""


@dataclass(frozen=True)
class Release:
    """Rows of a release: the load folders that hold them, their number, the
    sums of their fingerprint (decimal text), and the file they all come from
    (name, length, time of change, digest; None if unknown or several)."""

    folders: list[str]
    rows: int
    fingerprint: list[str]
    source: dict | None = None

    def plus(self, other: "Release") -> "Release":
        sums = [str(int(a) + int(b)) for a, b in zip(self.fingerprint, other.fingerprint)]
        return Release([*self.folders, *other.folders], self.rows + other.rows, sums)


@dataclass(frozen=True)
class Snapshot:
    number: int
    schema: dict
    partition_by: list[str]
    releases: dict[str, Release]  # "9/2012" -> Release
    action: str = ""
    load_id: str = ""

    def text(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def parse(text: str) -> "Snapshot":
        d = json.loads(text)
        return Snapshot(**{**d, "releases": {k: Release(**r) for k, r in d["releases"].items()}})


def release_key(version: int, fy: int) -> str:
    return f"{int(version)}/{int(fy)}"


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.records = f"{self.root}/_snapshots"

    # -- files -------------------------------------------------------------
    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[tuple[str, int]]:
        """(name, time of change in ms) of what lies in a folder of the store:
        one entry per snapshot or load."""
        fs, where = self._fs(), self._path(folder)
        return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(where)] if fs.exists(where) else []

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n, _ in self._names(self.records) if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, number: int) -> Snapshot:
        stream = self._fs().open(self._path(f"{self.records}/{number:010d}.json"))
        try:
            return Snapshot.parse(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> Snapshot | None:
        numbers = self.numbers()
        return self.snapshot(numbers[-1]) if numbers else None

    # -- reading -----------------------------------------------------------
    def read(self, number: int | None = None) -> DataFrame:
        """The table as of a snapshot (default: the current one).  Only the
        folders of its releases are listed; filters on version and year prune
        them."""
        snap = self.current() if number is None else self.snapshot(number)
        if snap is None:
            raise ValueError(f"no snapshot in {self.root}")
        return self.rows_of(snap)

    def rows_of(self, snap: Snapshot) -> DataFrame:
        schema = T.StructType.fromJson(snap.schema)
        folders: dict[str, list[str]] = {}
        for key, release in sorted(snap.releases.items()):
            values = key.split("/")
            for folder in release.folders:
                folders.setdefault(folder, []).append(f"{self.root}/{folder}/" + "/".join(f"{p}={v}" for p, v in zip(snap.partition_by, values)))
        out = None
        for folder, paths in folders.items():
            df = self.spark.read.schema(schema).option("basePath", f"{self.root}/{folder}").parquet(*paths).select(*schema.names)
            out = df if out is None else out.unionByName(df)
        return self.spark.createDataFrame([], schema) if out is None else out

    def fingerprints(self, number: int | None = None) -> DataFrame:
        """The stored fingerprints (ICD_Version, CMS_Fiscal_Year, n_rows, Sum_*)."""
        snap = self.current() if number is None else self.snapshot(number)
        rows = [(*map(int, k.split("/")), r.rows, *r.fingerprint) for k, r in (snap.releases.items() if snap else ())]
        names = ["ICD_Version", "CMS_Fiscal_Year", "n_rows", *FINGERPRINT]
        df = self.spark.createDataFrame(rows, "a int, b int, c long, d string, e string, f string, g string").toDF(*names)
        return df.select(*names[:3], *(F.col(c).cast("decimal(38,0)").alias(c) for c in FINGERPRINT))

    # -- publishing --------------------------------------------------------
    def check_action(self, action: str, base: Snapshot | None) -> str:
        action = str(action).upper()
        if action not in ACTIONS:
            raise ValueError(f"unknown table action {action!r}; use one of {ACTIONS}")
        if base is None and action not in ("DROP_CREATE", "APPEND", "REFRESH"):
            raise ValueError(f"{self.root} must hold a table for action {action}")
        return action

    def kept(self, action: str, base: Snapshot | None, loaded=()) -> dict[str, Release]:
        """The releases of ``base`` that stay under an action; ``loaded``: the
        (version, fiscal year, ...) of the releases that a refresh replaces."""
        if base is None or action in ("DROP_CREATE", "TRUNCATE"):
            return {}
        if action == "REFRESH":
            replaced = {release_key(*r[:2]) for r in loaded}
            return {k: r for k, r in base.releases.items() if k not in replaced}
        gone = {"DELETE_ICD9": "9", "DELETE_ICD10": "10"}.get(action)
        return {k: r for k, r in base.releases.items() if k.split("/")[0] != gone}

    def _write(self, df: DataFrame, spec: TableSpec, sort_col: str | None) -> tuple[T.StructType, dict[str, Release]]:
        """The rows in a folder of their own, with what it holds by release."""
        folder = f"data/{uuid.uuid4().hex}"
        rows, parts = df.select(*spec.names), list(spec.partition_by)
        dealt = rows.hint("rebalance", *parts).sortWithinPartitions(*parts, *([sort_col] if sort_col else []))
        dealt.write.option("maxRecordsPerFile", sinks.MAX_RECORDS_PER_FILE).partitionBy(*parts).parquet(f"{self.root}/{folder}")
        back = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{folder}").withColumnsRenamed(dict(zip(parts, ("ICD_Version", "CMS_Fiscal_Year"))))
        own = release_fingerprints(back, [c for c in back.columns if c not in ("ICD_Version", "CMS_Fiscal_Year")]).collect()  # one row per release
        return rows.schema, {release_key(r["ICD_Version"], r["CMS_Fiscal_Year"]): Release([folder], r["n_rows"], [str(r[c]) for c in FINGERPRINT]) for r in own}

    def publish(self, df: DataFrame, spec: TableSpec, action: str, base: Snapshot | None = None, load_id: str = "", sort_col: str | None = None,
                sources: dict[str, dict] | None = None) -> Snapshot:
        """Bring checked rows in by one of the table actions, as one commit on
        top of ``base`` (the snapshot that the checks have read; None for an
        empty store).  ``sources``: the file of every release that was loaded,
        by ``release_key``; a refresh replaces these releases and those that
        have rows."""
        action = self.check_action(action, base)
        schema, new = self._write(df, spec, sort_col)
        new = {k: replace(r, source=(sources or {}).get(k)) for k, r in new.items()}
        releases = self.kept(action, base, [k.split("/") for k in {*new, *(sources or ())}])
        if releases and [(f.name, f.dataType) for f in T.StructType.fromJson(base.schema)] != [(f.name, f.dataType) for f in schema]:
            raise ValueError(f"the columns of {self.root} differ from the load's; publish with DROP_CREATE")
        for key, release in new.items():
            releases[key] = releases[key].plus(release) if key in releases else release
        snap = Snapshot(base.number + 1 if base else 1, json.loads(schema.json()), list(spec.partition_by), releases, action, load_id)
        self._commit(snap)
        return snap

    def _commit(self, snap: Snapshot) -> None:
        jvm, fs = self.spark._jvm, self._fs()
        hidden, final = self._path(f"{self.records}/.next-{uuid.uuid4().hex}"), self._path(f"{self.records}/{snap.number:010d}.json")
        fs.mkdirs(self._path(self.records))
        stream = fs.create(hidden, False)
        try:
            stream.write(bytearray(snap.text().encode()))
        finally:
            stream.close()
        none = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.getFileSystem(self.spark._jsc.hadoopConfiguration()).getUri(), self.spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(hidden), fs.makeQualified(final), none)
        except Exception as e:
            fs.delete(hidden, False)
            if fs.exists(final):
                raise ConcurrentLoad(f"snapshot {snap.number} of {self.root} was published by another load") from e
            raise

    def vacuum(self, keep: int = 2, grace_seconds: float = 86_400) -> list[str]:
        """Remove the records before the last ``keep`` and the load folders that
        no remaining record names, if they are older than ``grace_seconds`` (a
        load may be writing, a reader may be reading)."""
        numbers, fs, gone = self.numbers(), self._fs(), []
        before = (time.time() - grace_seconds) * 1000
        named = {f for n in numbers[-keep:] for r in self.snapshot(n).releases.values() for f in r.folders}
        for n in numbers[:-keep]:
            fs.delete(self._path(f"{self.records}/{n:010d}.json"), False)
        for name, changed in self._names(f"{self.root}/data"):
            if f"data/{name}" not in named and changed <= before:
                fs.delete(self._path(f"{self.root}/data/{name}"), True)
                gone.append(name)
        return gone
