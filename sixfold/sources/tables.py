"""Warehouse tables as parquet folders, facts laid out per event, with commits.

Every write of a load goes to a folder of its own. A load ends with one small file, the commit, that names the folders of each table;
readers look at the latest commit only. So a load that breaks off changes nothing, a reader sees all of a load or none of it, and of
two loads that began at the same commit the second to end is refused.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sixfold import schema
from sixfold.operators.ordered import same_key

COMMITS = "_commits"
#: Bookkeeping tables: sessions whose load has ended, and events of older folders that a later one replaces.
ENDED, HIDDEN = "_loaded_sessions", "_hidden"
INTERNAL = {ENDED: "session_id string", HIDDEN: "of string, load string, event_id bigint"}


class CommitConflict(RuntimeError):
    """Another load has ended since this one began."""


def _fields(table: str) -> T.StructType:
    return T._parse_datatype_string(INTERNAL[table]) if table in INTERNAL else schema.struct(table)


@dataclass(frozen=True)
class Snapshot:
    """The folders that make up each table as of one commit; version 0 is the empty warehouse."""

    root: str
    version: int = 0
    folders: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def parts(self, spark: SparkSession, table: str) -> DataFrame:
        """All stored rows with the folder they come from in ``_part``, replaced ones too; empty with its schema if never written."""
        fields = _fields(table)
        named = T.StructType([*fields.fields, T.StructField("_part", T.StringType())])
        paths = [f"{self.root}/{table}/_part={part}" for part in self.folders.get(table, ())]
        if not paths:
            return spark.createDataFrame([], named)
        return spark.read.schema(named).option("basePath", f"{self.root}/{table}").parquet(*paths).select(*named.names)

    def table(self, spark: SparkSession, table: str) -> DataFrame:
        rows = self.parts(spark, table)
        if table != HIDDEN and table in schema.PARTITIONED and self.folders.get(HIDDEN) and self.folders.get(table):
            hidden = self.parts(spark, HIDDEN).where(F.col("of") == table).select(F.col("load").alias("_part"), "event_id")
            rows = rows.join(hidden, ["_part", "event_id"], "left_anti")
        return rows.select(*_fields(table).names)


def latest(spark: SparkSession, root: str) -> Snapshot:
    """The warehouse as of its latest commit. Names of commits are listed, one of them is read."""
    try:
        listed = spark.read.format("binaryFile").load(f"{root}/{COMMITS}/*.json").select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return Snapshot(root)
    last = listed.agg(F.max("path")).first()[0]
    held = json.loads(spark.read.text(last, wholetext=True).first().value)
    return Snapshot(root, held["version"], held["folders"])


class Load:
    """A load in progress: it reads what was committed when it began and what it has written itself.

    ``keep`` names the tables that stay (None: all); the others begin empty.
    """

    def __init__(self, spark: SparkSession, root: str, keep: Collection[str] | None = None):
        self.spark, self.root, self.base, self.id, self.writes = spark, root, latest(spark, root), uuid.uuid4().hex, 0
        self.folders = {t: list(f) for t, f in self.base.folders.items() if keep is None or t in keep}

    def _now(self) -> Snapshot:
        return Snapshot(self.root, self.base.version, {t: tuple(f) for t, f in self.folders.items()})

    def read(self, table: str) -> DataFrame:
        return self._now().table(self.spark, table)

    def append(self, df: DataFrame, table: str) -> str:
        """Add rows. They are gathered per event, and a large event is split over several files. Returns the folder's name."""
        out = conform(df, table)
        part = f"{self.id}-{self.writes}"
        self.writes += 1
        if table in schema.PARTITIONED:
            out.hint("rebalance", "event_id").write.partitionBy("event_id").parquet(f"{self.root}/{table}/_part={part}")
        else:
            out.write.parquet(f"{self.root}/{table}/_part={part}")
        self.folders.setdefault(table, []).append(part)
        return part

    def replace(self, df: DataFrame, table: str) -> None:
        """Replace the events that occur in ``df``: rows that older folders have of them no longer count."""
        before = self._now()
        part = self.append(df, table)
        if not before.folders.get(table):
            return
        events = Snapshot(self.root, 0, {table: [part]}).parts(self.spark, table).select("event_id").distinct()
        old = before.parts(self.spark, table).select("_part", "event_id").distinct().join(events, "event_id", "left_semi")
        self.append(old.select(F.lit(table).alias("of"), F.col("_part").alias("load"), "event_id"), HIDDEN)

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        """Store an intermediate table of this load and read it back: computed once, of known size."""
        path = f"{self.root}/_scratch/{self.id}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> Snapshot:
        """Make the load visible in one step, or raise ``CommitConflict`` if another load has ended since this one began.

        The file is renamed into place without overwriting, which file systems that take part in Spark's own output commits do in
        one step (HDFS and those like it; a local disk looks before it renames).
        """
        done = Snapshot(self.root, self.base.version + 1, self.folders)
        jvm = self.spark._jvm
        place = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.root}/{COMMITS}/{name}")
        target, draft = place(f"{done.version:020d}.json"), place(f".{self.id}.tmp")
        conf = self.spark._jsc.hadoopConfiguration()
        stream = target.getFileSystem(conf).create(draft, True)
        stream.write(bytearray(json.dumps({"version": done.version, "folders": done.folders}).encode()))
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(conf).makeQualified(target).toUri(), conf)
        never = self.spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(draft, target, never)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            target.getFileSystem(conf).delete(draft, False)
            raise CommitConflict(f"{self.root}: version {done.version} was committed by another load") from None
        return done


def read_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables by name, as of the latest commit."""
    now = latest(spark, root)
    return {table: now.table(spark, table) for table in schema.TABLES}


def remove_unused(spark: SparkSession, root: str, hours: float = 168) -> list[str]:
    """Delete the folders of broken or superseded loads that were last written more than ``hours`` ago; returns their paths.

    Readers and loads that began before the latest commit may still use such folders: choose more hours than any of them takes.
    """
    used = {part for parts in latest(spark, root).folders.values() for part in parts}
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    since = spark._jvm.System.currentTimeMillis() - hours * 3_600_000
    gone = []
    for table in [*schema.TABLES, *INTERNAL, "_scratch"]:
        folder = path(f"{root}/{table}")
        for status in files.listStatus(folder) if files.exists(folder) else ():
            if status.getPath().getName().removeprefix("_part=") not in used and status.getModificationTime() < since:
                files.delete(status.getPath(), True)
                gone.append(status.getPath().toString())
    return gone


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns with their types; a value that does not fit its column becomes NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in _fields(table)])


def stored(df: DataFrame) -> DataFrame:
    """``df``, written to the folder that all executors share and read back: computed once and of known size, so a small table is broadcast."""
    context = df.sparkSession.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="sixfold-stored-")
    path = f"{folder}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_per_key(df: DataFrame, key: Iterable[str], order: Iterable[str] = ()) -> DataFrame:
    """One row per key: the first along ``order``, then along the other columns.

    An aggregate, not a window: copies of one key shrink to one row per task before they are shuffled.
    """
    key, order = list(key), list(order)
    rest = [c for c in df.columns if c not in key]
    ranked = order + [c for c in rest if c not in order]
    picked = df.groupBy(*key).agg(F.min(F.struct(*ranked)).alias("_row")) if ranked else df.select(*key).distinct()
    return picked.select(*[F.col(c) if c in key else F.col("_row")[c].alias(c) for c in df.columns])


def absent(new: DataFrame, existing: DataFrame, key: Iterable[str], order: Iterable[str] = ()) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet, one per key."""
    key = list(key)
    once = first_per_key(new, key, order).alias("n")
    stored = existing.select(*key).alias("e")
    return once.join(stored, same_key([F.col(f"n.{k}") for k in key], [F.col(f"e.{k}") for k in key]), "left_anti").select("n.*")
