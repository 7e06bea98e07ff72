"""One large JSON object read by many tasks.

A file like ``{"target": {"1": "Yes", "2": "No", ...}}`` is one record to a JSON reader, so one task. Here it is read as
text that ends records at each comma, which Spark can split anywhere. Most pieces are whole entries. A comma inside a
string cuts an entry; such pieces are found by their quotes: a piece begins inside a string exactly if an odd number of
the pieces before it have an odd number of quotes (escaped ones aside; an escape can't stand across a comma). These odd pieces
are counted over all splits from counts for each block of lines, and each odd-numbered one is grouped with what follows up
to the next: pieces, not the file, are brought together. Nothing that grows with the pieces is broadcast.

Values are scalars (text, numbers, true, false; null gives a null value). Keys that repeat give a row each, in no order.
The wrapping field, if any, must be the file's only top-level field. White space anywhere outside of strings, escapes, and
separators in strings are as JSON has them. What doesn't parse fails the query with the piece, or is counted and left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.sources.files import tolerant
from cardwatch.sources.positions import if_few, numbered, with_place, written

_STRING = r'"(?:[^"\\]|\\.)*"'
#: One entry: a key and a scalar.
ENTRY = rf'(?s)^\s*({_STRING})\s*:\s*({_STRING}|[^\s"{{}}\[\],]+)\s*$'


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pieces(spark: SparkSession, path: str, scratch: str, split_bytes: int | None = None, **opts) -> DataFrame:
    """(file, line, value, odd): the text between commas, numbered in each file; written to ``scratch`` once."""
    text = with_place(tolerant(spark.read, **opts).option("lineSep", ",").text(path))
    quotes = "length(regexp_replace(regexp_replace(value, '(?s)\\\\\\\\.', ''), '[^\"]', ''))"
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if split_bytes:
        spark.conf.set(key, split_bytes)
    try:
        stored = written(text.withColumn("odd", F.expr(f"{quotes} % 2 = 1")), f"{scratch}/pieces")
    finally:
        spark.conf.set(key, before)
    return numbered(stored)


#: Lines of a file that are numbered together: no sorted group has more pieces.
BLOCK = 100_000


def _counted(cut: DataFrame, scratch: str) -> DataFrame:
    """Add to each piece: ``n``, a number for its file's name; ``c``, the odd pieces before it in its file; ``odds``, those
    of the whole file; ``hi``, the file's last line.

    Odd pieces are counted in blocks of lines, with the counts of the blocks before. Only these counts (a row for each block)
    are joined with the pieces, and the name of a file isn't repeated in what is sorted."""
    blocked = cut.withColumn("block", F.expr(f"line DIV {BLOCK}"))
    blocks = blocked.groupBy("file", "block").agg(F.count_if("odd").alias("some"), F.max("line").alias("top"))
    own = Window.partitionBy("file")
    before = own.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("file").alias("of"), F.col("block").alias("at"), F.dense_rank().over(Window.orderBy("file")).alias("n"),
        F.coalesce(F.sum("some").over(before), F.lit(0)).alias("before"), F.sum("some").over(own).alias("odds"), F.max("top").over(own).alias("hi"))
    blocks = written(blocks, f"{scratch}/blocks")
    near = blocked.join(if_few(blocks), F.expr("file = of AND block = at")).drop("file", "of", "at")
    inside = Window.partitionBy("n", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    counted = F.col("before") + F.coalesce(F.sum(F.col("odd").cast("long")).over(inside), F.lit(0))
    return near.withColumn("c", counted).drop("block", "before")


def read_object(spark: SparkSession, path: str, key_name: str, value_name: str, scratch: str, wrap: str | None = None,
                on_malformed: str = "raise", split_bytes: int | None = None, **opts) -> DataFrame:
    """(key, value) rows of files that hold one JSON object each, ``wrap`` naming the field with the entries.

    ``scratch``: a new folder of the shared storage for the numbered pieces. ``on_malformed``: "raise" or "drop".
    ``split_bytes``: bytes of a file that one task reads (the session's by default)."""
    cut = pieces(spark, path, scratch, split_bytes, **opts)
    counted = _counted(cut, scratch)
    if on_malformed == "raise":
        unclosed = spark.read.parquet(f"{scratch}/blocks").where("odds % 2 = 1").select("of").first()
        if unclosed:
            raise ValueError(f"a string is open at the end of {unclosed[0]}")
    # what follows the quote of a string that isn't closed stands by itself
    alone = "NOT odd AND (c % 2 = 0 OR c = odds)"
    whole = counted.where(alone).select("value", (F.col("line") == 1).alias("leads"), F.expr("line = hi").alias("ends"))
    # the odd piece that opens a string, what stands inside it, and the odd piece that closes it have the same half of ``c``
    mended = counted.where(f"NOT ({alone})").groupBy("n", F.expr("c DIV 2").alias("k")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), ",").alias("value"),
        (F.min("line") == 1).alias("leads"), F.expr("max(line) = max(hi)").alias("ends"))
    found = whole.unionByName(mended.select(*whole.columns))
    # the braces around all entries belong to the first and the last entry of a file
    opening = r"^\s*\{" + (rf'\s*"\Q{wrap}\E"\s*:\s*\{{' if wrap else "")
    closing = r"\}" + (r"\s*\}" if wrap else "") + r"\s*$"
    bare = (f"IF(ends, regexp_replace(opened, {_sql('(?s)' + closing)}, ''), opened)")
    found = found.withColumn("opened", F.expr(f"IF(leads, regexp_replace(value, {_sql('(?s)' + opening)}, ''), value)"))
    found = found.withColumn("entry", F.expr(bare)).where("NOT (leads AND ends AND trim(entry) = '')")  # an empty object
    # brackets that are left, or were missing, don't match an entry
    sound = (f"entry RLIKE {_sql(ENTRY)} AND NOT (leads AND opened = value) AND NOT (ends AND entry = opened)")
    key, value = (f"regexp_extract(entry, {_sql(ENTRY)}, {k})" for k in (1, 2))
    parsed = found.withColumn("pair", F.expr(f"IF({sound}, from_json(concat('{{\"k\":', {key}, ',\"v\":', {value}, '}}'), 'k STRING, v STRING'), NULL)"))
    if on_malformed == "raise":
        parsed = parsed.withColumn("pair", F.expr("IF(pair.k IS NULL, raise_error(concat('malformed entry: ', left(entry, 80))), pair)"))
    return parsed.where("pair.k IS NOT NULL").select(F.col("pair.k").alias(key_name), F.col("pair.v").alias(value_name))
