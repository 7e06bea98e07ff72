"""Dated full snapshots in a partitioned bronze table, published by manifests.

Layout: ``<root>/<dataset>/snapshot_date=yyyy-MM-dd/run=<id>/part-*.parquet``. Each write goes to run folders of its
own. A date's manifest (its run, files, rows and checksum, ``_published/<date>/<time>-<run>.json``) is written when all
files are in place, by a rename of one small file. A date counts as loaded when it has a manifest, and reads open the run
that its newest manifest names: a job that dies before that leaves files that nothing reads, its date is loaded again,
and who reads while a date is replaced sees the old run or the new one, never both. Rows and checksum are observed while
the files are written, so no second pass is needed.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.functions.scalar import date_text
from cardwatch.operators.selection import smallest_k

PART = "snapshot_date"


def snapshot_dates(df: DataFrame, date_col: str = "date_insertion") -> DataFrame:
    """Distinct snapshot dates as ``yyyy-MM-dd`` text."""
    return df.select(date_text(date_col).alias(PART)).distinct()


def snapshot_bounds(df: DataFrame, date_col: str = "date_insertion", id_col: str = "id") -> DataFrame:
    """Per snapshot: lowest and highest id and row count (the bounds of a range-partitioned read)."""
    return df.groupBy(date_text(date_col).alias(PART)).agg(
        F.min(id_col).alias("lo"), F.max(id_col).alias("hi"), F.count(F.lit(1)).alias("n"))


#: Dates of one write job; each adds two observed figures to it.
DATES_A_JOB = 50
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: Bytes that a task's open files hold together before they are written (8 MB a file at least).
OPEN_BYTES = 128 << 20


def row_checksum(columns: Iterable[str]) -> Column:
    """Sum of the rows' hashes: the same for the same rows in any order, and repeats count."""
    return F.sum(F.xxhash64(*columns).cast("decimal(20,0)"))


def write_snapshots(df: DataFrame, path: str, date_col: str = "date_insertion", num_files: int | None = None,
                    dates: Iterable[str] | None = None) -> list[str]:
    """Write (or replace) and publish the snapshots in ``df``; other dates on disk are untouched. Returns the dates.

    ``dates``: those to write, if they are known; else one pass over the date column finds them (one per day, bounded).
    """
    spark = df.sparkSession
    known = dates if dates is not None else (r[0] for r in snapshot_dates(df, date_col).collect() if r[0])
    todo = sorted(set(known))
    for k in range(0, len(todo), DATES_A_JOB):
        some = todo[k:k + DATES_A_JOB]
        for manifest in _write_run(df, path, date_col, num_files, some):
            publish(spark, path, manifest)
    return todo


def _write_run(df: DataFrame, path: str, date_col: str, num_files: int | None, dates: list[str]) -> list[dict]:
    """Write the files of some dates; returns their manifests, which nothing refers to yet."""
    spark, run, seen = df.sparkSession, uuid.uuid4().hex[:12], Observation()
    # the column itself is compared, so the filter reaches the source
    out = df.where(F.col(date_col).isin([dt.date.fromisoformat(d) for d in dates]))
    out = out.withColumn(PART, date_text(date_col)).drop(date_col)
    if num_files:
        out = out.repartition(num_files)
    own = sorted(c for c in out.columns if c != PART)
    figures = []
    for k, d in enumerate(dates):
        here = F.col(PART) == d
        figures += [F.count_if(here).alias(f"rows_{k}"), F.sum(F.when(here, F.xxhash64(*own).cast("decimal(20,0)"))).alias(f"sum_{k}")]
    written = out.observe(seen, *figures).withColumn("run", F.lit(run))
    writer = written.write.mode("append").partitionBy(PART, "run")
    if num_files:
        # few tasks write it all: a file for each date stays open in each, so that no task sorts its rows by date first
        before = spark.conf.get(OPEN_FILES)
        spark.conf.set(OPEN_FILES, len(dates))
        try:
            writer.option("parquet.block.size", max(8 << 20, OPEN_BYTES // len(dates))).parquet(path)
        finally:
            spark.conf.set(OPEN_FILES, before)
    else:
        writer.parquet(path)
    got = seen.get
    return [{"snapshot_date": d, "run": run, "rows": got[f"rows_{k}"], "checksum": str(got[f"sum_{k}"] or 0),
             "files": _files(spark, f"{path}/{PART}={d}/run={run}")} for k, d in enumerate(dates)]


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _files(spark: SparkSession, path: str) -> list[list]:
    """[name, bytes] of the visible files in a folder."""
    place, fs = _folder(spark, path)
    if not fs.exists(place):
        return []
    found = ((f.getPath().getName(), f.getLen()) for f in fs.listStatus(place))
    return sorted([n, size] for n, size in found if not n.startswith(("_", ".")))


def publish(spark: SparkSession, path: str, manifest: dict) -> None:
    """Make a date's run the one that is read: its manifest appears under its name at once and whole."""
    folder = f"{path}/_published/{manifest['snapshot_date']}"
    name = f"{time.time_ns():020d}-{manifest['run']}.json"
    draft, fs = _folder(spark, f"{folder}/_{name}")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    if not fs.rename(draft, _folder(spark, f"{folder}/{name}")[0]):
        raise OSError(f"could not publish {folder}/{name}")


def published(spark: SparkSession, path: str) -> dict[str, dict]:
    """The newest manifest of each date (one per day, read by the driver)."""
    folder, fs = _folder(spark, f"{path}/_published")
    out = {}
    for day in fs.listStatus(folder) if fs.exists(folder) else ():
        names = sorted(n for n, _ in _files(spark, day.getPath().toString()))
        if names:
            stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(day.getPath(), names[-1]))
            out[day.getPath().getName()] = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            stream.close()
    return dict(sorted(out.items()))


def _read_runs(spark: SparkSession, path: str, schema: T.StructType, date_col: str, manifests: list[dict], **opts) -> DataFrame:
    """Rows of the runs that the manifests name, with ``snapshot_date``. A listed file that is gone or of another size is an error."""
    full = T.StructType([*(f for f in schema.fields if f.name != date_col), T.StructField(PART, T.StringType()), T.StructField("run", T.StringType())])
    some = [m for m in manifests if m["files"]]
    if not some:
        return spark.createDataFrame([], full).drop("run")
    folders = []
    for m in some:
        folder = f"{path}/{PART}={m['snapshot_date']}/run={m['run']}"
        if _files(spark, folder) != sorted(m["files"]):
            raise FileNotFoundError(f"{folder} isn't what its manifest lists")
        folders.append(folder)
    reader = spark.read.schema(full).option("basePath", path)
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.parquet(*folders).drop("run")


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType, date_col: str = "date_insertion",
                   **opts) -> DataFrame:
    """All published snapshots, with the date restored from the partition value."""
    df = _read_runs(spark, path, schema, date_col, [*published(spark, path).values()], **opts)
    return df.withColumn(date_col, F.to_date(F.col(PART))).drop(PART)


def read_latest(spark: SparkSession, path: str, schema: T.StructType, date_col: str = "date_insertion",
                **opts) -> DataFrame:
    """Rows of the newest published snapshot only; no file of another one is listed or opened. No snapshot: no rows."""
    newest = [*published(spark, path).values()][-1:]
    rows = _read_runs(spark, path, schema, date_col, newest, **opts)
    return rows.where(F.col(PART) == newest[0]["snapshot_date"] if newest else F.lit(False)).drop(PART)


def damaged_snapshots(spark: SparkSession, path: str, schema: T.StructType, date_col: str = "date_insertion") -> DataFrame:
    """(snapshot_date, rows, checksum, found_rows, found_checksum) of dates whose rows on disk aren't those that were written."""
    manifests = published(spark, path)
    wanted = spark.createDataFrame([(d, m["rows"], m["checksum"]) for d, m in manifests.items()], f"{PART} string, rows long, checksum string")
    read = _read_runs(spark, path, schema, date_col, [*manifests.values()])
    own = sorted(c for c in read.columns if c != PART)
    found = read.groupBy(PART).agg(F.count(F.lit(1)).alias("found_rows"), row_checksum(own).cast("string").alias("found_checksum"))
    return wanted.join(found, PART, "left").where("NOT (rows <=> coalesce(found_rows, 0) AND checksum <=> coalesce(found_checksum, '0'))")


def listed_dates(spark: SparkSession, path: str) -> list[str]:
    """Published snapshot dates."""
    return [*published(spark, path)]


def committed_dates(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot dates published in the bronze table (empty when the table does not exist)."""
    return spark.createDataFrame([(d,) for d in listed_dates(spark, path)], T.StructType([T.StructField(PART, T.StringType())]))


def dates_to_load(source_dates: DataFrame, committed: DataFrame) -> DataFrame:
    """Wanted dates that are not committed yet (left anti join; neither side is collected)."""
    return source_dates.join(committed, PART, "left_anti")


def load_missing(spark: SparkSession, source: DataFrame, path: str, date_col: str = "date_insertion") -> list[str]:
    """Write only the snapshots missing from ``path``; returns the dates loaded (one per day, bounded)."""
    todo = sorted(r[0] for r in dates_to_load(snapshot_dates(source, date_col), committed_dates(spark, path)).collect())
    return write_snapshots(source, path, date_col, dates=todo)


def replicate_static(static: DataFrame, dates: DataFrame, date_col: str = "date_insertion") -> DataFrame:
    """A static dataset stamped with every snapshot date (one copy per date).

    The date list is bounded by the number of snapshot days (one per day), so it is gathered
    and each row is repeated through ``explode`` of that literal list.
    """
    values = sorted(dt.date.fromisoformat(r[0]) for r in dates.select(PART).distinct().collect())
    arr = F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<date>")
    return static.withColumn(date_col, F.explode(arr))


def write_static(spark: SparkSession, static: DataFrame, dates: DataFrame, path: str) -> list[str]:
    """Stamp a static dataset with the dates it does not have yet; what earlier runs wrote stays as it is."""
    todo = dates_to_load(dates.select(PART).distinct(), committed_dates(spark, path))
    new = sorted(r[0] for r in todo.collect())
    if new:
        write_snapshots(replicate_static(static, todo), path, dates=new)
    return new


def first_share_by_id(df: DataFrame, share: float, id_col: str = "id", of_rows: int | None = None, **limits) -> DataFrame:
    """The first ``floor(share * n)`` rows in id order, exactly, without a global sort.

    ``of_rows``: the number of rows that the share is of, if not those of ``df`` (all lines of a file, valid or not)."""
    from decimal import Decimal

    frac = Decimal(str(share))
    return smallest_k(df, id_col, [F.col(id_col)] + [F.col(c) for c in df.columns if c != id_col],
                      k_of=lambda counts: {g: int((Decimal(n if of_rows is None else of_rows) * frac).to_integral_value(rounding="ROUND_FLOOR"))
                                           for g, n in counts.items()}, **limits)
