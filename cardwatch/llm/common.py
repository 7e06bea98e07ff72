"""Shared helpers: scratch tables in the cluster's shared folder, column guards, character runs.

``runs`` finds the words of many texts at once with numpy: code points are mapped to classes by a table,
word borders are where classes change, and polynomial hashes of every word come from running sums.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import unicodedata
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.session import shared_path

#: Separates texts that are joined to one array. Spark strings hold no lone surrogates, so no text has it.
SEP = "\ud800"
OTHER, LETTER, NUMBER, SPACE, BREAK = range(5)
#: Code points with the Unicode property White_Space (fixed values).
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_BASE = np.uint64(0x9E3779B97F4A7C15)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared storage and read it back.

    It cuts the lineage: a lost executor costs a re-read, and every later job sees the same rows. The
    folder may go once the result that was computed from it is written.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def need(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Spark hand Python this many rows at a time at most: documents may be long, and its default is 10 000."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, rows)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@functools.cache
def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space, break (surrogates) or other."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], dtype=np.uint8)
    table[WHITE] = SPACE
    table[0xD800:0xE000] = BREAK
    return table


#: Span hashes are polynomials modulo this prime, to two bases; quick ones are modulo 2^64 (fixed values).
_PRIME = (1 << 31) - 1
_BASES, _QUICK = (0x2545F491, 0x3C6EF372), 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    """Values below 2^62 modulo the prime."""
    prime, shift = np.uint64(_PRIME), np.uint64(31)
    x = (x & prime) + (x >> shift)
    x = (x & prime) + (x >> shift)
    x[x >= prime] -= prime
    return x


def _power_table(base: int, n: int) -> np.ndarray:
    """base^i for i < n, modulo 2^64 if the base is beyond the prime, else modulo the prime."""
    quick = base > _PRIME
    known = _powers.get(base)
    if known is None:
        known = np.ones(1, dtype=np.uint64)
    while len(known) < n:
        more = known * np.uint64(pow(base, len(known), 1 << 64 if quick else _PRIME))
        known = np.concatenate([known, more if quick else _reduced(more)])
    _powers[base] = known
    return known


_kept: dict[str, dict] = {}


def kept(work: str) -> dict:
    """What a Python worker keeps from task to task of one kind of work.

    Spark uses its workers again for whatever stage comes next: the first task of other work drops this, and hands the memory
    that it took back to the system, where the C library has a call for that. Results don't depend on it."""
    if _kept.keys() != {work}:
        _kept.clear()
        _powers.clear()
        with contextlib.suppress(AttributeError, OSError):
            ctypes.CDLL(None).malloc_trim(0)
        _kept[work] = {}
    return _kept[work]


def join_texts(texts: list[str]) -> np.ndarray:
    """Code points of all texts, each followed by SEP."""
    return np.frombuffer((SEP.join(texts) + SEP).encode("utf-32-le", "surrogatepass"), dtype="<u4")


def span_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of code points; equal spans get equal hashes anywhere. Unequal ones may, though
    hardly ever: ``number_spans`` tells them apart."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for base in _BASES:
        up, down = _power_table(base, len(points) + 1), _power_table(pow(base, -1, _PRIME), len(points) + 1)
        terms = (points + np.uint64(1)) * up[: len(points)]
        total = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum((terms & np.uint64(_PRIME)) + (terms >> np.uint64(31)), out=total[1:])
        out = out << np.uint64(31) | _reduced(_reduced(total[ends] - total[starts]) * down[starts])
    return mix(out)


def _quick_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As ``span_hashes``, at a third of its cost; some long unequal spans always share one, so it never decides."""
    up, down = _power_table(_QUICK, len(points) + 1), _power_table(pow(_QUICK, -1, 1 << 64), len(points) + 1)
    total = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum((points + np.uint64(1)) * up[: len(points)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def number_spans(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, at_once: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """(a span for each number, the number of each span): equal numbers exactly for equal code points.

    Spans are grouped by hash, then each is compared with its group's span; what differs is numbered by its content.
    """
    _, index, number = np.unique(_quick_hashes(points, starts, ends), return_index=True, return_inverse=True)
    size = ends - starts
    model = index[number]
    unlike = size != size[model]
    upto = np.cumsum(size)
    place_type = np.int32 if len(points) < 1 << 31 else np.int64
    first = 0
    while first < len(starts):  # spans of about ``at_once`` code points
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + at_once, "right")))
        some = np.arange(first, last)
        some = some[(model[some] != some) & ~unlike[some]]
        n = size[some]
        edge = np.cumsum(n) - n
        place = np.repeat((starts[some] - edge).astype(place_type), n) + np.arange(int(n.sum()), dtype=place_type)
        away = np.repeat((starts[model[some]] - starts[some]).astype(place_type), n)
        wrong = np.flatnonzero(points[place] != points[place + away])
        unlike[some[np.searchsorted(edge, wrong, "right") - 1]] = True
        first = last
    if unlike.any():
        numbers: dict[bytes, int] = {}
        more = []
        for i in np.flatnonzero(unlike).tolist():
            content = points[starts[i]:ends[i]].tobytes()
            if content not in numbers:
                numbers[content] = len(index) + len(more)
                more.append(i)
            number[i] = numbers[content]
        index = np.concatenate([index, np.array(more, dtype=index.dtype)])
    return index, number


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix64 finaliser)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[str], limit: int = 1_000_000):
    """(first index, texts) groups of about ``limit`` characters; one longer text is a group of its own."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, texts[first:]


def space_spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between white space of all texts: (code points, starts, ends, index of the text)."""
    points = join_texts(texts)
    kind = char_classes()[points]
    edge = np.diff((kind < SPACE).astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return points, starts, ends, np.searchsorted(np.flatnonzero(kind == BREAK), starts)


def text_hash(text: bytes) -> int:
    """What Spark's xxhash64 gives for a string, as a signed number."""
    h = xxhash.xxh64_intdigest(text, 42)
    return h - (1 << 64) if h >> 63 else h


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``kept`` names by ``keep_id`` and ``keep_hash`` (xxhash64 of the text).

    Null ids match null ids. If rows repeat both id and text, one of them stays.
    """
    own, its_id, its_hash = fresh(docs, "__own_hash", "__keep_id", "__keep_hash")
    names = kept.select(F.col("keep_id").alias(its_id), F.col("keep_hash").alias(its_hash)).distinct()
    keyed = docs.withColumn(own, F.expr("xxhash64(coalesce(text, ''))"))
    same = F.col("doc_id").eqNullSafe(F.col(its_id)) & (F.col(own) == F.col(its_hash))
    chosen = keyed.join(names, same, "left_semi")
    again = keyed.groupBy("doc_id", own).count().where("count > 1").select(F.col("doc_id").alias(its_id), F.col(own).alias(its_hash))
    if again.isEmpty():
        return chosen.drop(own)
    once = chosen.join(again, same, "left_semi").dropDuplicates(["doc_id", own])
    return chosen.join(again, same, "left_anti").unionByName(once).drop(own)
