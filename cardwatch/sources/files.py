"""File readers and writers with explicit schemas.

- CSV with a header (money stays text until cleaned);
- JSON objects mapping a key to a value (``{"5411": "..."}``) or wrapped under one field
  (``{"target": {"123": "Yes"}}``), exploded into (key, value) rows;
- line JSON read permissively, dropping corrupt lines through a declared ``_corrupt_record``.

The object format is one record per object, hence one task per object. The writer therefore
splits a table into objects of bounded size (one per line); the reader accepts either such
line-delimited objects or whole-file objects.
"""

from __future__ import annotations

import math
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.sources.positions import numbered, with_place

CORRUPT = "_corrupt_record"
ENTRIES_PER_OBJECT = 100_000
KNOWN_FORMATS = ("csv", "json", "parquet")


def format_of(path: str) -> str:
    """Format by file suffix; unknown suffixes are rejected rather than skipped silently."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower().lstrip(".")
    if suffix not in KNOWN_FORMATS:
        raise ValueError(f"unsupported file type {suffix!r} for {path}")
    return suffix


def tolerant(reader, ignore_corrupt: bool = False, ignore_missing: bool = False):
    """Skip unreadable or vanished files (off by default: silent data loss must be asked for)."""
    return reader.option("ignoreCorruptFiles", str(ignore_corrupt).lower()).option(
        "ignoreMissingFiles", str(ignore_missing).lower())


def require_columns(df: DataFrame, path: str) -> DataFrame:
    if not df.columns:
        raise ValueError(f"empty schema read from {path}")
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **opts) -> DataFrame:
    reader = tolerant(spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE"), **opts)
    return require_columns(reader.csv(path), path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, drop_corrupt: bool = True,
                    **opts) -> DataFrame:
    """Line JSON, PERMISSIVE; corrupt lines are dropped via the declared corrupt-record column.

    Lines are read as text (splittable) and parsed with ``from_json``, so a query that needs no
    data column (``count()``) still parses every line and still drops the corrupt ones.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    lines = tolerant(spark.read, **opts).text(path).where(F.trim(F.col("value")) != "")  # blank lines are no records
    parsed = lines.select(F.from_json(F.col("value"), full, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r")).select("r.*")
    if drop_corrupt:
        parsed = parsed.where(F.col(CORRUPT).isNull())
    return require_columns(parsed.drop(CORRUPT), path)


#: Why a line was put aside.
NOT_JSON, NOT_OBJECT = "not JSON", "not an object"


def split_json_lines(spark: SparkSession, path: str, schema: T.StructType, scratch: str, **opts) -> tuple[DataFrame, DataFrame]:
    """Line JSON -> (good rows, lines put aside) out of one read, which is written to ``scratch`` (a new shared folder).

    What is put aside: ``file``, ``line`` (number in the file, from 1), ``reason`` and the ``record``. The reason is that the
    line is not JSON, not an object, or which fields have a value that doesn't fit. Blank lines are no records, but count as lines.
    Good and bad rows together are all records."""
    lines = with_place(tolerant(spark.read, **opts).text(path))
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    blank = F.trim("value") == ""
    read = lines.withColumn("row", F.when(~blank, parsed)).withColumn("kind", F.expr(f"CASE WHEN row IS NULL THEN 'blank' WHEN row.{CORRUPT} IS NULL THEN 'good' ELSE 'bad' END"))
    read.withColumn("value", F.when(F.col("kind") == "bad", F.col("value"))).write.partitionBy("kind").parquet(f"{scratch}/lines")
    stored = spark.read.schema(read.schema).parquet(f"{scratch}/lines")
    good = require_columns(stored.where("kind = 'good'").select(*(F.col(f"row.`{f.name}`") for f in schema.fields)), path)
    # only the bad lines' text is read again; a field fits if the line parses with that field alone
    fits = [F.when(F.from_json("value", T.StructType([f, T.StructField(CORRUPT, T.StringType())]),
                               {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).getField(CORRUPT).isNotNull(), F.lit(f.name)) for f in schema.fields]
    json = F.expr("try_parse_json(value)")
    reason = F.when(json.isNull(), NOT_JSON).when(~F.expr("coalesce(schema_of_variant(try_parse_json(value)) LIKE 'OBJECT%', false)"), NOT_OBJECT).otherwise(
        F.concat(F.lit("does not fit: "), F.array_join(F.array_compact(F.array(*fits)), ", ")))
    bad = numbered(stored.select("place", "kind", "value")).where("kind = 'bad'")
    return good, bad.select("file", "line", reason.alias("reason"), F.col("value").alias("record"))


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json_objects(df: DataFrame, key_col: str, value_col: str, path: str, wrap: str | None = None,
                       entries_per_object: int = ENTRIES_PER_OBJECT) -> None:
    """Write (key, value) rows as JSON objects of at most ~``entries_per_object`` entries, one per line.

    Keys must be unique (deduplicate first). Rows go to objects by a hash of the key, so every
    object is built by one bounded group, never the whole table.
    """
    n = df.count()
    chunks = max(1, math.ceil(n / entries_per_object))
    obj = F.map_from_entries(F.collect_list(F.struct(F.col(key_col).cast("string"), F.col(value_col))))
    body = F.struct(obj.alias(wrap)) if wrap else obj
    (df.groupBy(F.pmod(F.xxhash64(F.col(key_col).cast("string")), F.lit(chunks)).alias("__chunk"))
       .agg(F.to_json(body).alias("value"))
       .select("value")
       .write.mode("overwrite").text(path))


def read_json_objects(spark: SparkSession, path: str, key_name: str, value_name: str, wrap: str | None = None,
                      whole_file: bool = False, on_malformed: str = "raise", **opts) -> DataFrame:
    """(key, value) rows out of JSON objects, one object per line or (``whole_file``) per file.

    An object that can't be parsed, or lacks the wrapping field, may hold any number of entries: it fails the query
    unless ``on_malformed`` is "drop" (``malformed_objects`` counts what that drops)."""
    mtype = T.MapType(T.StringType(), T.StringType())
    schema = T.StructType([T.StructField(wrap, mtype)]) if wrap else mtype
    reader = tolerant(spark.read, **opts)
    raw = reader.text(path, wholetext=whole_file).where(F.trim("value") != "")
    parsed = F.from_json(F.col("value"), schema)
    m = parsed.getField(wrap) if wrap else parsed
    if on_malformed == "raise":
        m = F.when(m.isNull(), F.raise_error(F.concat(F.lit("malformed JSON object: "), F.left("value", F.lit(80))))).otherwise(m)
    return raw.select(F.explode(m).alias(key_name, value_name))


def malformed_objects(spark: SparkSession, path: str, wrap: str | None = None, whole_file: bool = False) -> DataFrame:
    """One row: the number of objects and of those that don't parse."""
    mtype = T.MapType(T.StringType(), T.StringType())
    parsed = F.from_json(F.col("value"), T.StructType([T.StructField(wrap, mtype)]) if wrap else mtype)
    m = parsed.getField(wrap) if wrap else parsed
    lines = spark.read.text(path, wholetext=whole_file).where(F.trim("value") != "")
    return lines.agg(F.count(F.lit(1)).alias("objects"), F.count_if(m.isNull()).alias("malformed"))


def path_is_missing(error: Exception) -> bool:
    """True only for the error of reading a path that does not exist."""
    return isinstance(error, AnalysisException) and error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_any(spark: SparkSession, path: str, schema: T.StructType, **opts) -> DataFrame:
    """Dispatch on the suffix: csv, line json or parquet."""
    fmt = format_of(path)
    if fmt == "csv":
        return read_csv(spark, path, schema, **opts)
    if fmt == "json":
        return read_json_lines(spark, path, schema, **opts)
    return require_columns(tolerant(spark.read.schema(schema), **opts).parquet(path), path)
