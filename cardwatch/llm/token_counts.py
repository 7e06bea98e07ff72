"""Token counts behind a digest cache.

A text's normal form (what the tokenizer makes of it before anything else) is named by its SHA-256, and a tokenizer by
the SHA-256 of its file, its library and that library's version. A shared Parquet folder holds the counts known for each
tokenizer version. A run joins its texts' distinct digests to the stored counts, encodes one text for each digest
that isn't there, appends those counts as a new batch, and joins the counts back to the rows.

- A copied text is collapsed in the task that reads it and again after the shuffle: it is encoded once, and a text on a
  third of all rows reaches one task once for each reading task.
- Texts travel only if their digest is new: known texts are left out before the shuffle when the new digests are counted
  and few enough to broadcast, else after it.
- A batch is a folder of its own. Every stored row is right by itself, so a batch that a dead job left in part, or that
  two jobs wrote at once, only costs room; repeated digests are reduced to one when the cache is read.

Null text counts as empty; an empty text has no tokens and 0 bytes. Ties and repeated rows each get a row of the result.
Texts are encoded whole, whatever their length. Extra columns stay; columns with the names of the results are replaced.
An empty table gives an empty table and stores nothing.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import chunks, fresh, need, small_batches, stage
from cardwatch.session import shared_path

#: New digests that are broadcast to leave known texts out before the shuffle (32 bytes each).
BROADCAST_DIGESTS = 500_000
COUNTS = "digest binary, n_tokens long"


@functools.cache
def _sentencepiece(content: bytes):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


@functools.cache
def _tokenizers(content: bytes):
    from tokenizers import Tokenizer

    model = Tokenizer.from_str(content.decode())
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]


class Tokens:
    """A tokenizer file: its content, its version digest, its counter and the normal form that keeps counts.

    A sentencepiece model with the identity normaliser writes blanks as U+2581 before it looks for pieces; there a text
    and its form with U+2581 for blanks have the same tokens. For other files the normal form is the text itself.
    """

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.content = f.read()
        self.library = "sentencepiece" if path.endswith(".model") else "tokenizers"
        head = f"{self.library} {version(self.library)}\n".encode()
        self.version = hashlib.sha256(head + self.content).hexdigest()
        self.escapes_blanks = self.library == "sentencepiece" and _writes_blanks(self.content)

    def normal(self, text: str) -> str:
        """SQL of the normal form of a column."""
        whole = f"coalesce({text}, '')"
        return f"replace({whole}, ' ', '▁')" if self.escapes_blanks else whole


def _writes_blanks(content: bytes) -> bool:
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(content)
    rules = model.normalizer_spec
    return not rules.precompiled_charsmap and rules.escape_whitespaces and not rules.remove_extra_whitespaces


def stored(spark: SparkSession, folder: str, tokens: Tokens) -> DataFrame:
    """The counts that the cache holds for this tokenizer version: one row for each digest."""
    at = f"{folder}/tokenizer={tokens.version}"
    place = spark._jvm.org.apache.hadoop.fs.Path(at)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], COUNTS)
    rows = spark.read.schema(COUNTS).option("recursiveFileLookup", "true").parquet(at)
    return rows.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def _encode(texts: DataFrame, tokens: Tokens) -> DataFrame:
    """(digest, n_tokens) of rows (digest, text)."""
    file, library = texts.sparkSession.sparkContext.broadcast(tokens.content), tokens.library

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _sentencepiece(file.value) if library == "sentencepiece" else _tokenizers(file.value)
        for batch in batches:
            found = []
            for _, part in chunks(batch.column("text").to_pylist()):
                found += count(part)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(found, pa.int64())], names=["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(run, COUNTS)


def count_tokens(df: DataFrame, tokenizer_path: str, folder: str | None = None, text: str = "text") -> DataFrame:
    """Add ``n_bytes`` (UTF-8) and ``n_tokens`` to ``df``; ``folder`` is the cache (a shared one by default)."""
    need(df, text)
    spark, tokens = df.sparkSession, Tokens(tokenizer_path)
    small_batches(spark)
    folder = folder or shared_path(spark, "llm-cache", "token-counts")
    df = df.drop(*(c for c in ("n_bytes", "n_tokens") if c != text))
    digest = fresh(df, "digest")[0]
    name = F.expr(f"unhex(sha2({tokens.normal(f'`{text}`')}, 256))")
    keyed = df.withColumns({"n_bytes": F.expr(f"CAST(octet_length(coalesce(`{text}`, '')) AS BIGINT)"), digest: name})
    # of the text only its digest is needed to find and to join counts
    seen = stage(df.select(name.alias("digest")).groupBy("digest").count().select("digest"), "digests")
    known = stage(seen.join(stored(spark, folder, tokens), "digest", "left"), "known")
    new = known.where("n_tokens IS NULL").select("digest")
    total, missing = known.count(), new.count()
    counts = known.where("n_tokens IS NOT NULL")
    if missing:
        texts = df.select(name.alias("digest"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        if missing <= BROADCAST_DIGESTS:
            texts = texts if missing == total else texts.join(F.broadcast(new), "digest", "left_semi")
            texts = texts.dropDuplicates(["digest"])
        else:
            texts = texts.dropDuplicates(["digest"])
            texts = texts if missing == total else texts.join(new, "digest", "left_semi")
        batch = f"{folder}/tokenizer={tokens.version}/batch={uuid.uuid4().hex}"
        _encode(texts, tokens).write.parquet(batch)
        counts = counts.unionByName(spark.read.schema(COUNTS).parquet(batch))
    # both sides are shuffled for this join, so a digest on very many rows is split at run time
    return keyed.join(counts.withColumnRenamed("digest", "its_" + digest), F.col(digest) == F.col("its_" + digest)).drop(digest, "its_" + digest)
