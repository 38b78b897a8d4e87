"""Tables as immutable loads with a commit log.

    <folder>/<table>/loads/_load=<id>/_part=<date>/*.parquet     what one load wrote; never changed afterwards
    <folder>/<table>/files/*.parquet                             the source files that loads were read from
    <folder>/<table>/log/*.json                                  one row for each commit

A load counts from the moment its row is in the log, which is one file and appears at once. So a job that ends early
leaves the table as it was, a reload or a replacement of some parts is seen whole or not at all, and older versions can be
read until they are cleared away. The log has one row per load and is read by the driver. One writer per table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.observed import figures
from ledgerline.session import CODEC, freed, sized

PART, LOAD = "_part", "_load"
# Fixed value: the name Spark gives to the partition of null.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
LOG = (
    "version long, load string, mode string, rows long, batch string, dated_by string, low string, high string, "
    "held array<string>, covered array<string>, schema string, committed_at timestamp"
)
FILES = "path string, modificationTime timestamp, length long, load string"


class NoTable(LookupError):
    """Nothing was committed under this name, or not up to this version."""


class SchemaChanged(ValueError):
    """A load's columns or types differ from those of the table it should be added to."""


@dataclass(frozen=True)
class Live:
    """What is left of a load: all of its parts, or some of them."""

    commit: Row
    parts: frozenset[str]

    def paths(self, root: str, wanted: frozenset[str] | None) -> list[str]:
        folder = f"{root}/{LOAD}={self.commit.load}"
        if not self.commit.dated_by or (wanted is None and self.parts == frozenset(self.commit.held)):
            return [folder]
        return [f"{folder}/{PART}={part}" for part in sorted(self.parts if wanted is None else self.parts & wanted)]


class Layer:
    """Versioned tables below one shared folder. Dated tables are cut into parts by ``grain`` (day, month or year)."""

    def __init__(self, spark: SparkSession, folder: str, grain: str = "month") -> None:
        self.spark, self.folder, self.grain = spark, folder.rstrip("/"), grain

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    # -- the log --------------------------------------------------------------------------------------------

    def _store(self, folder: str):
        """The path of a folder and the file system it is on, as Spark's own Hadoop classes."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _written(self, folder: str) -> bool:
        path, store = self._store(folder)
        return store.exists(path)

    def commits(self, table: str) -> DataFrame:
        """The commit log, one row per load, with no rows where there is no table."""
        log = f"{self.path(table)}/log"
        return self.spark.read.schema(LOG).json(log) if self._written(log) else self.spark.createDataFrame([], LOG)

    def live(self, table: str, version: int | None = None) -> list[Live]:
        """The loads a version (the last by default) consists of, with the parts that later ones have not replaced."""
        found: list[Live] = []
        for commit in sorted(self.commits(table).collect(), key=lambda c: c.version):
            if version is not None and commit.version > version:
                break
            if commit.mode == "replace":
                found = []
            elif commit.mode == "parts":
                found = [Live(old.commit, old.parts - frozenset(commit.covered)) for old in found]
            found.append(Live(commit, frozenset(commit.held or ())))
        return [x for x in found if x.parts or not x.commit.dated_by or not x.commit.held]

    def version(self, table: str) -> int:
        """The number of the last commit; 0 where there is none."""
        return max((commit.version for commit in self.commits(table).collect()), default=0)

    def exists(self, table: str) -> bool:
        return self.version(table) > 0

    def high_water(self, table: str) -> date | None:
        """The latest date among the rows of the table."""
        marks = [x.commit.high for x in self.live(table) if x.commit.high]
        return date.fromisoformat(max(marks)) if marks else None

    # -- writing --------------------------------------------------------------------------------------------

    def load(
        self,
        df: DataFrame,
        table: str,
        replace: bool = False,
        *,
        dated_by: str | None = None,
        batch: str | None = None,
        parts: Iterable[date | str] | None = None,
        files: DataFrame | None = None,
        finish: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """Append the rows, or put them in the place of the table, or of some ``parts`` of it; returns their number.

        ``dated_by`` names the date column whose day, month or year is a row's part; rows without a date have a part of
        their own. With ``parts`` all rows have to lie in them, and parts without rows end up empty. ``files`` (path,
        modificationTime, length) are noted as loaded. Columns and types must be those of the table unless it is replaced.
        ``finish`` adds columns that follow from a row's others; rows move to their parts without them.
        """
        finish = finish or (lambda rows: rows)
        schema = finish(df).schema
        if not replace:
            self._same_kind(schema, table, dated_by)
        name, path = f"l{uuid.uuid4().hex}", self.path(table)
        seen = Observation(f"load_{name}")
        rows = F.count(F.lit(1)).alias("rows")
        folder = f"{path}/loads/{LOAD}={name}"
        if dated_by:
            day = F.col(dated_by).cast("date")
            part = F.date_trunc(self.grain, day).cast("date")
            held = F.collect_set(F.coalesce(part.cast("string"), F.lit(NULL_PART))).alias("held")
            marks = [F.min(day).cast("string").alias("low"), F.max(day).cast("string").alias("high"), held]
            # Rows of a part meet in few files, and a large part is split over tasks.
            placed = df.observe(seen, rows, *marks).withColumn(PART, part).hint("rebalance", PART).drop(PART)
            writer = finish(placed).withColumn(PART, part).write.partitionBy(PART)
        else:
            writer = finish(df.observe(seen, rows)).write
        with freed(self.spark):
            writer.parquet(folder, compression=CODEC)
        found = {"rows": 0} | figures(seen, lambda: self.spark.read.schema(schema).parquet(folder))
        held, covered = sorted(found.get("held") or []), sorted(str(p) for p in parts or ())
        if parts is not None and not set(held) <= set(covered):
            raise ValueError(f"rows outside the parts to be replaced: {sorted(set(held) - set(covered))}")
        if files is not None:
            noted = files.select("path", "modificationTime", "length", F.lit(name).alias("load"))
            noted.write.mode("append").parquet(f"{path}/files")
        mode = "replace" if replace else "append" if parts is None else "parts"
        low, high = found.get("low"), found.get("high")
        self._commit(table, name, mode, int(found["rows"]), batch, dated_by, low, high, held, covered, schema.json())
        return int(found["rows"])

    def _same_kind(self, schema: T.StructType, table: str, dated_by: str | None) -> None:
        live = self.live(table)
        if not live:
            return
        last = live[-1].commit
        known = [(f.name, f.dataType) for f in T.StructType.fromJson(json.loads(last.schema))]
        given = [(f.name, f.dataType) for f in schema]
        if known != given:
            raise SchemaChanged(f"{table}: {[f'{n} {t.simpleString()}' for n, t in set(known) ^ set(given)] or 'order of columns'}")
        if last.dated_by != dated_by:
            raise SchemaChanged(f"{table} is dated by {last.dated_by}, not by {dated_by}")

    def _commit(self, table: str, *fields) -> None:
        """The step that makes a load count."""
        row = (self.version(table) + 1, *fields, datetime.now(timezone.utc))
        self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").json(f"{self.path(table)}/log")

    def clear(self, table: str) -> list[str]:
        """Delete the loads that the last version has nothing of, also those of jobs that ended early; returns their ids.

        Older versions can't be read any more. Not while a load is being written.
        """
        live = {x.commit.load for x in self.live(table)}
        root, store = self._store(f"{self.path(table)}/loads")
        if not store.exists(root):
            return []
        gone = [s.getPath() for s in store.listStatus(root) if s.getPath().getName().removeprefix(f"{LOAD}=") not in live]
        for folder in gone:
            store.delete(folder, True)
        return sorted(folder.getName().removeprefix(f"{LOAD}=") for folder in gone)

    # -- reading --------------------------------------------------------------------------------------------

    def table(
        self,
        table: str,
        version: int | None = None,
        since: date | None = None,
        parts: Sequence[date | str] | None = None,
    ) -> DataFrame:
        """A version of the table (the last by default) with the columns and types it was committed with.

        ``since`` keeps the rows from that date on and ``parts`` those of the given parts; both are partition filters, so
        that no other file is opened.
        """
        live = self.live(table, version)
        if not live:
            raise NoTable(table if version is None else f"{table}, version {version}")
        schema = T.StructType.fromJson(json.loads(live[-1].commit.schema))
        dated_by, root = live[-1].commit.dated_by, f"{self.path(table)}/loads"
        paths = [path for x in live for path in x.paths(root, None if parts is None else frozenset(map(str, parts)))]
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
        if dated_by:
            stored = stored.add(PART, T.DateType())
        df = sized(self.spark.read.schema(stored).option("basePath", root).parquet(*paths))
        if since is not None and dated_by:
            start = since.replace(day=1) if self.grain == "month" else since.replace(month=1, day=1) if self.grain == "year" else since
            df = df.where((F.col(PART) >= F.lit(start)) & (F.col(dated_by) >= F.lit(since)))
        return df.select(*schema.names)

    def count(self, table: str) -> int:
        """Rows of the table. Untouched loads are counted by the log, those with replaced parts by their files."""
        live = self.live(table)
        whole = sum(x.commit.rows for x in live if x.parts == frozenset(x.commit.held or ()))
        cut = [x for x in live if x.parts != frozenset(x.commit.held or ())]
        paths = [path for x in cut for path in x.paths(f"{self.path(table)}/loads", None)]
        return whole + (self.spark.read.parquet(*paths).count() if paths else 0)

    def files(self, table: str) -> DataFrame:
        """The source files whose rows are in the table: path, modificationTime, length and load."""
        loads = [x.commit.load for x in self.live(table)]
        noted = f"{self.path(table)}/files"
        if not self._written(noted):
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(noted).where(F.col("load").isin(loads))


class RawLayer(Layer):
    """The raw tables, as a source for a warehouse on top of them."""

    def raw(self, entity: str) -> DataFrame:
        return self.table(f"raw_{entity}")
