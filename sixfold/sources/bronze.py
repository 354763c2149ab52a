"""Raw session files: ``{dataset}_{session_id}.csv`` tables and ``session_info_{session_id}.json`` documents."""

from __future__ import annotations

import csv
import re
import warnings
from collections.abc import Collection, Mapping
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sixfold.functions.columns import durations_to_seconds
from sixfold.schema import DATASETS

# Cell texts that mean "missing" in the files.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


# What a path must escape to be read as it is.
_GLOB = re.compile(r"([\[\]{}*?\\,])")


def _session_of_file(dataset: str, ending: str):
    # The session id is in the file's own name, or in the folder's name where Spark wrote the files.
    return F.regexp_extract(F.col("_metadata.file_path"), rf"/{dataset}_([^/]+)\.{ending}", 1)


def _files(spark: SparkSession, root: str, dataset: str, ending: str, sessions: Collection[str] | None) -> DataFrame | None:
    """``path`` of the files of a dataset (or of those of the given sessions). Their names are listed, their contents are not read."""
    try:
        listed = spark.read.format("binaryFile").load(f"{root}/{dataset}_*.{ending}").select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if sessions is None:
        return listed
    wanted = spark.createDataFrame([(s,) for s in sorted(sessions)], "session_id string")
    named = listed.withColumn("session_id", F.regexp_extract("path", rf"/{dataset}_([^/]+)\.{ending}", 1))
    return named.join(wanted, "session_id", "left_semi").select("path")


#: Bytes of a file that are read at once to find the end of its first line.
HEAD = 1 << 14


def first_lines(files: DataFrame) -> DataFrame:
    """``path, line``: the first line of each file; Spark lists no empty ones. Only the beginning of a file is read, however long it is.

    Each task opens its share of the files. A file system that Arrow cannot open from its path alone is read by Spark's text reader,
    which has to pass over whole files.
    """

    def heads(batches):
        for batch in batches:
            lines = [first_line(path) for path in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string())], names=["path", "line"])

    one = files.first()
    try:
        if one is not None:
            file_system(one.path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        paths = [_GLOB.sub(r"\\\1", r.path) for r in files.collect()]
        starts = files.sparkSession.read.text(paths).where(F.col("_metadata.file_block_start") == 0)
        placed = starts.select(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("path"), "value", F.monotonically_increasing_id().alias("at"))
        return placed.groupBy("path").agg(F.min_by("value", "at").alias("line"))
    return files.mapInArrow(heads, "path string, line string")


def first_line(path: str) -> str | None:
    system, place = file_system(path)
    with system.open_input_stream(place, buffer_size=HEAD) as stream:
        held = b""
        while b"\n" not in held and b"\r" not in held and (more := stream.read(HEAD)):
            held += more
    return re.split(rb"[\r\n]", held, maxsplit=1)[0].decode(errors="replace") if held else None


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a path as Spark writes it (not escaped), and the place in it."""
    if path.startswith(("/", "file:")):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(quote(path, safe="/:@"))


def list_sessions(spark: SparkSession, root: str) -> list[str]:
    """The ids of the sessions that have a document, by the names of the files."""
    try:
        listed = spark.read.format("binaryFile").load(f"{root}/session_info_*.json")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    named = listed.select(F.regexp_extract("path", r"/session_info_([^/]+)\.json", 1).alias("session_id")).distinct()
    return sorted(r.session_id for r in named.collect())


def read_dataset(spark: SparkSession, root: str, dataset: str, sessions: Collection[str] | None = None) -> DataFrame | None:
    """All sessions of one dataset (or the given ones), every cell as text plus ``session_id``; None with a warning if there is no file.

    Each file is read by its own header: columns may be in any order, and one that a file lacks is NULL there. A first pass takes the
    header lines and no more of the files; files with the same header share one scan, so there are as many scans as different headers.
    The names of the files and the different headers reach the driver, which lists the files anyway. ``_row`` rises along each file. It is taken on the scan, before any shuffle, so a repeated task gives a row the same number.

    Cells stay text here: the loaders cast them by name, so one bad cell costs that cell and not the file.
    """
    if dataset not in DATASETS:
        raise ValueError(f"unknown dataset {dataset}")
    files = _files(spark, root, dataset, "csv", sessions)
    if files is None:
        warnings.warn(f"no {dataset} files under {root}", stacklevel=2)
        return None
    headers = first_lines(files).where("line IS NOT NULL")
    groups = headers.groupBy(F.col("line").alias("header")).agg(F.collect_list("path").alias("files")).collect()
    parts = []
    for header, files in sorted((g.header, sorted(g.files)) for g in groups):
        names = next(csv.reader([header.removeprefix("\ufeff")]))
        part = spark.read.csv(
            [_GLOB.sub(r"\\\1", f) for f in files],
            schema=T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))]),
            header=True,
            escape='"',
            # Only messages hold free text with line breaks; the large files stay splittable.
            multiLine=dataset == "race_control_messages",
        )
        # Of columns with the same name the first counts; a column without a name has no use.
        place = {name: f"_c{i}" for i, name in reversed(list(enumerate(names))) if name}
        cells = [F.when(~F.col(c).isin(*MISSING), F.col(c)).alias(name) for name, c in sorted(place.items())]
        parts.append(part.select(*cells, _session_of_file(dataset, "csv").alias("session_id")))
    if not parts:  # empty files only
        warnings.warn(f"no {dataset} rows under {root}", stacklevel=2)
        return None
    # Scans under a union have no shuffle between them: the numbers rise along each file and are the same for a repeated task.
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts).withColumn("_row", F.monotonically_increasing_id())


def read_session_info(spark: SparkSession, root: str, sessions: Collection[str] | None = None) -> DataFrame | None:
    """One row per session (or per given session): ``session_id`` and the whole document as text; None with a warning if there is no file."""
    files = _files(spark, root, "session_info", "json", sessions)
    paths = [] if files is None else [_GLOB.sub(r"\\\1", r.path) for r in files.collect()]
    if not paths:
        warnings.warn(f"no session_info files under {root}", stacklevel=2)
        return None
    raw = spark.read.text(paths, wholetext=True)
    session = _session_of_file("session_info", "json").alias("session_id")
    return raw.select(session, F.col("value").alias("document"), F.monotonically_increasing_id().alias("_row"))


def write_dataset(df: DataFrame | None, root: str, dataset: str, session_id: str) -> bool:
    """Write one dataset of one session as CSV, durations as seconds; an empty one is skipped."""
    if df is None or df.isEmpty():
        warnings.warn(f"no rows for {dataset}_{session_id}, skipped", stacklevel=2)
        return False
    durations_to_seconds(df).write.mode("overwrite").csv(f"{root}/{dataset}_{session_id}.csv", header=True, escape='"')
    return True


def envelope(df: DataFrame) -> DataFrame:
    """Each row as one JSON text ``{exported_at, data: {...}}``, missing values as explicit nulls."""
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    body = F.struct(stamp.alias("exported_at"), F.struct(*df.columns).alias("data"))
    return df.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def write_session_info(df: DataFrame, root: str, session_id: str) -> None:
    """Write the session's metadata row as a JSON document."""
    envelope(df).write.mode("overwrite").text(f"{root}/session_info_{session_id}.json")


def tag_and_concat(parts: Mapping[str, DataFrame], session_id: str, limit: int | None = None) -> DataFrame | None:
    """One frame from one per driver, tagged with driver and session; the first ``limit`` drivers only, if given."""
    chosen = list(parts.items())[:limit]
    tagged = [df.withColumns({"Driver": F.lit(driver), "SessionId": F.lit(session_id)}) for driver, df in chosen]
    if not tagged:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def limit_drivers(telemetry: DataFrame, drivers: DataFrame, limit: int, by: str = "Driver") -> DataFrame:
    """Rows of the first ``limit`` drivers of an ordered driver list."""
    return telemetry.join(drivers.orderBy("place").limit(limit).select(by), by, "left_semi")
