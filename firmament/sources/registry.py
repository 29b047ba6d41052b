"""Versioned master on plain Parquet and the report and statistics sinks.

A version is a list of segments.  A segment is a folder that nobody rewrites, its tables in hash
buckets of company_id.  The base segment of a bucket holds all its companies; a delta holds the
companies that one batch touched, whole, and their ids.  Readers take a company from the last
segment that touched it.  So a batch writes what it touches, and ``compact`` turns buckets with
many segments into new bases.

A commit is one JSON file named by its version, which is put in place by a rename that fails if
the name is taken.  It names the version it was derived from.  A writer whose master came from an
older version than the newest gets a ``Conflict`` and loses nothing: it reads again and
resolves its batch anew, as ``update`` does.  A job that dies half-way leaves no commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmament.schemas import MASTER_TABLES, RETIRED, SIDE_TABLES, Master, check_master, empty_master

_COMMIT_SCHEMA = (
    "version bigint, base bigint, writer string, batch_id bigint, mark bigint, "
    "segments array<struct<folder: string, version: bigint, delta: boolean, buckets: array<int>>>"
)
BATCH_JOB = "batch"  # writer of commits that no stream made
COMPACTION = "compaction"
BUCKETS = 64  # of a new store; a bucket may take many files
DELTAS = 8  # segments that a bucket may have before it is due for compaction
_TABLES = {**MASTER_TABLES, **SIDE_TABLES}


class Conflict(RuntimeError):
    """Another writer has committed since the master was read."""


class RegistryStore:
    """Reads and writes versions of the master below one folder."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS, deltas: int = DELTAS):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.buckets = buckets
        self.deltas = deltas

    # --- Commits -----------------------------------------------------------------

    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(_COMMIT_SCHEMA).json(f"{self.folder}/commits")
        except AnalysisException:
            return self.spark.createDataFrame([], _COMMIT_SCHEMA)

    def last_commit(self):
        """Newest commit row or None; one row, found by a distributed top-1."""
        newest = self.commits().orderBy(F.col("version").desc()).head(1)
        return newest[0] if newest else None

    def has_batch(self, batch_id: int, writer: str = BATCH_JOB) -> bool:
        return not self.commits().filter((F.col("writer") == writer) & (F.col("batch_id") == batch_id)).isEmpty()

    def _commit(self, base: int, writer: str, batch_id: int, mark: int, segments: list[dict]) -> int:
        """Put the commit after ``base`` in place, or raise ``Conflict``; returns its version."""
        version = base + 1
        row = {"version": version, "base": base, "writer": writer, "batch_id": batch_id, "mark": mark, "segments": segments}
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits/{version:012d}.json")
        draft = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits/_{uuid.uuid4().hex}")
        out = target.getFileSystem(conf).create(draft, False)
        out.write(bytearray(json.dumps(row).encode() + b"\n"))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(conf).makeQualified(target).toUri(), conf)
        plain = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        plain[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        try:
            files.rename(draft, target, plain)
        except Py4JJavaError as error:
            files.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                raise Conflict(f"version {version} is there already") from None
            raise
        return version

    # --- Reading -----------------------------------------------------------------

    def _bucket(self):
        return F.pmod(F.xxhash64("company_id"), F.lit(self.buckets)).cast("int")

    def _rows(self, segment, table: str, schema: T.StructType, only: list[int] | None) -> DataFrame:
        """Rows of one segment in the buckets it counts in, with its version."""
        stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        buckets = [b for b in segment["buckets"] if only is None or b in only]
        rows = self.spark.read.schema(stored).parquet(f"{segment['folder']}/{table}")
        if len(buckets) < self.buckets:
            rows = rows.filter(F.col("bucket").isin(buckets))
        return rows.withColumn("segment", F.lit(segment["version"]))

    def _table(self, commit, table: str, only: list[int] | None = None) -> DataFrame:
        """A table as a commit has it: of every company the rows of the last segment that touched it."""
        schema = _TABLES[table]
        parts = [self._rows(s, table, schema, only) for s in commit["segments"]]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        deltas = [self._rows(s, "touched", RETIRED, only) for s in commit["segments"] if s["delta"]]
        if deltas:
            touched = deltas[0]
            for part in deltas[1:]:
                touched = touched.unionByName(part)
            last = touched.groupBy("company_id").agg(F.max("segment").alias("last"))
            rows = rows.join(last, "company_id", "left").filter(F.col("segment") >= F.coalesce("last", "segment"))
        return rows.select(*schema.names)

    def read(self, version: int | None = None) -> Master:
        """A committed version, the newest by default, or an empty master."""
        commit = self.last_commit() if version is None else self.commits().filter(F.col("version") == version).head()
        if commit is None:
            return empty_master(self.spark).with_tables(version=0)
        tables = {name: self._table(commit, name) for name in _TABLES}
        return Master(**tables, mark=commit["mark"], version=commit["version"])

    # --- Writing -----------------------------------------------------------------

    def _save(self, tables: dict[str, DataFrame]) -> str:
        """Tables of a new segment in a folder of its own."""
        folder = f"{self.folder}/segments/{uuid.uuid4().hex}"

        def save(name: str) -> None:
            dealt = tables[name].withColumn("bucket", self._bucket())
            dealt.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{folder}/{name}")

        with ThreadPoolExecutor(len(tables)) as pool:  # a job per table, side by side
            list(pool.map(inheritable_thread_target(self.spark)(save), tables))
        return folder

    def _highest(self, folder: str, mark: int) -> int:
        """The largest id of a segment and all before it."""
        found = self.spark.read.schema(MASTER_TABLES["companies"]).parquet(f"{folder}/companies").agg(F.max("company_id").alias("top")).head()
        return max(mark, found["top"] or 0)

    def write(self, master: Master, batch_id: int, writer: str = BATCH_JOB) -> None:
        """Write a whole master as the next version; a batch that this writer has committed is left alone.

        A master that was read here must come from the newest version, else this is a ``Conflict``.
        One that was made elsewhere replaces what there is.
        """
        if self.has_batch(batch_id, writer):
            return
        last = self.last_commit()
        newest = last["version"] if last else 0
        if master.version not in (None, newest):
            raise Conflict(f"the master is of version {master.version}, the newest one is {newest}")
        tables = {**{n: self.spark.createDataFrame([], s) for n, s in SIDE_TABLES.items()}, **check_master(master).all_tables()}
        folder = self._save(tables)
        mark = self._highest(folder, max(master.mark, last["mark"] if last else 0))
        segment = {"folder": folder, "version": newest + 1, "delta": False, "buckets": list(range(self.buckets))}
        self._commit(newest, writer, batch_id, mark, [segment])

    def append(self, changed: Master, touched: DataFrame, batch_id: int, writer: str = BATCH_JOB) -> None:
        """Commit the companies that a batch touched, whole, on top of the version ``changed`` comes from."""
        last = self.last_commit()
        if last is None:
            return self.write(changed, batch_id, writer)
        if last["version"] != changed.version:
            raise Conflict(f"the changes are of version {changed.version}, the newest one is {last['version']}")
        folder = self._save({**check_master(changed).all_tables(), "touched": touched})
        buckets = sorted(r["bucket"] for r in touched.select(self._bucket().alias("bucket")).distinct().collect())
        segment = {"folder": folder, "version": changed.version + 1, "delta": True, "buckets": buckets}
        mark = self._highest(folder, last["mark"])
        self._commit(changed.version, writer, batch_id, mark, [s.asDict() for s in last["segments"]] + [segment] * bool(buckets))

    def update(self, work: Callable[[Master], tuple[Master, DataFrame]], batch_id: int, writer: str = BATCH_JOB) -> None:
        """Commit ``work(master) -> (changed, touched)`` on the newest version, again if another writer was faster."""
        while not self.has_batch(batch_id, writer):
            try:
                self.append(*work(self.read()), batch_id, writer)
            except Conflict:
                continue
            self.compact()

    def due(self, commit) -> list[int]:
        """Buckets that more than ``deltas`` segments count in."""
        held = {}
        for segment in commit["segments"]:
            for bucket in segment["buckets"]:
                held[bucket] = held.get(bucket, 0) + 1
        return sorted(b for b, n in held.items() if n > self.deltas)

    def compact(self) -> bool:
        """Rewrite the buckets that are due as one base; what other writers commit meanwhile goes first."""
        last = self.last_commit()
        due = self.due(last) if last else []
        if not due:
            return False
        folder = self._save({name: self._table(last, name, due) for name in _TABLES})
        segments = [{**s.asDict(), "buckets": [b for b in s["buckets"] if b not in due]} for s in last["segments"]]
        base = {"folder": folder, "version": last["version"] + 1, "delta": False, "buckets": due}
        try:
            self._commit(last["version"], COMPACTION, last["version"], last["mark"], [s for s in segments if s["buckets"]] + [base])
        except Conflict:
            return False
        return True


def write_report(report: DataFrame, path: str, fmt: str = "csv") -> bool:
    """Write a report in parallel; an empty one writes nothing and returns False."""
    if report.isEmpty():
        return False
    if fmt == "csv":
        report.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)
    else:
        report.write.mode("errorifexists").format(fmt).save(path)
    return True


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    """A report written as CSV; cells hold line ends, so a file is read by one task."""
    return spark.read.schema(schema).options(header=True, escape='"', multiLine=True).csv(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """One JSON object per site."""
    stats.write.mode("overwrite").json(path)
