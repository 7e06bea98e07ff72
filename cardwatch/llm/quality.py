"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(bias + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)): all pairwise
interactions in time linear in the features that a text has. Features are

- hashed words and runs of signs (case folded), weighted log(1 + count) and scaled to length 1,
- statistics of the text's structure, each as one of ``BINS`` quantile bins of the training rows,
- numeric metadata columns on a log scale, binned in the same way, with a bin of their own for null.

The model is fitted on at most ``SAMPLE`` labelled rows, chosen by a hash of their id; every text is scored whole.

Null text counts as empty; empty texts are scored by their statistics. Rows are scored one by one, so repeated
rows and ties change nothing, and an empty table gives an empty table. Extra columns pass through; a column
with the score's name is replaced. Without labelled rows of both classes the score is the share of label 1 (0.5 if none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm.common import BREAK, LETTER, NUMBER, OTHER, SPACE, char_classes, chunks, join_texts, kept, need, small_batches, span_hashes

#: Labelled rows used for the fit.
SAMPLE = 8000
BUCKETS, FACTORS, BINS = 1 << 16, 8, 16
EPOCHS, BATCH, RATE, DECAY, SEED = 12, 64, 0.08, 1e-5, 7
#: A word's bucket gets weights if it is in so many training texts.
MIN_TEXTS = 3
#: Value of a statistic's bin feature.
BIN_VALUE = 0.4

_tables: dict[str, np.ndarray] = {}


def _case() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of every code point (where it is one code point), and whether it is upper case."""
    if not _tables:
        low = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            if c < 0xD800 or c >= 0xE000:
                x = chr(c).lower()
                if len(x) == 1:
                    low[c] = ord(x)
        _tables["low"], _tables["upper"] = low, low != np.arange(0x110000)
    return _tables["low"], _tables["upper"]


def describe(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, bucket, count) of the words, in text order, and the statistics of each text."""
    low, upper = _case()
    points = join_texts(texts)
    kind = char_classes()[points]
    ends = np.flatnonzero(kind == BREAK)
    starts = np.concatenate([[0], ends[:-1] + 1])
    per_text = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[np.append(starts, len(points))])
    group = np.where(kind == NUMBER, LETTER, kind)
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    stop = np.append(edge[1:], len(points))
    is_token = group[edge] < SPACE
    edge, stop = edge[is_token], stop[is_token]
    sign = group[edge] == OTHER
    doc = np.searchsorted(ends, edge)
    n = len(texts)
    word = span_hashes(low[points], edge, stop)
    bucket = (word >> np.uint64(20)).astype(np.int64) % BUCKETS
    again = np.concatenate([[False], (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])])[: len(word)]
    code, count = np.unique(doc * BUCKETS + bucket, return_counts=True)
    of, bucket = code // BUCKETS, code % BUCKETS

    new_line = (points == 10) | (kind == BREAK)
    line_end = np.flatnonzero(new_line)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    line_doc = np.searchsorted(ends, line_start)
    full = line_end > line_start
    line = span_hashes(points, line_start[full], line_end[full])
    _, first = np.unique(line ^ (line_doc[full].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    lines = np.bincount(line_doc[full], minlength=n)
    distinct_lines = np.bincount(line_doc[full][first], minlength=n)

    chars = (ends - starts).astype(float)
    letters, digits, signs = per_text(kind == LETTER), per_text(kind == NUMBER), per_text((kind == OTHER))
    words = np.bincount(doc[~sign], minlength=n)
    runs = np.bincount(doc[sign], minlength=n)
    long_runs = np.bincount(doc[sign & (stop - edge > 1)], minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, of, count)
    share = lambda a, b: a / np.maximum(b, 1)
    stats = np.stack([
        np.log1p(chars), np.log1p(words), share(letters + digits, words), share(per_text(upper[points]), letters), share(digits, chars),
        share(signs, chars), share(long_runs, words), share(runs, words), share(chars - letters - digits - signs, chars),
        np.log1p(lines), share(chars, lines), 1 - share(distinct_lines, lines), share(np.bincount(of, minlength=n), words + runs), share(most, words + runs),
        share(np.bincount(doc[again], minlength=n), words + runs),
    ], axis=1)
    return of, bucket, count, stats


@dataclass
class Model:
    bias: float = 0.0
    edges: np.ndarray = field(default_factory=lambda: np.zeros((0, BINS - 1)))
    #: Row of ``weights`` and ``factors`` for each word bucket (0: none, all zero); bins come after the words.
    row_of: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, dtype=np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((1, FACTORS)))
    words: int = 1

    def features(self, of: np.ndarray, bucket: np.ndarray, count: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text index, row, value), sorted by text."""
        n, k = stats.shape
        value = np.log1p(count)
        norm = np.sqrt(np.bincount(of, value * value, n))
        value = value / norm[of]
        row = self.row_of[bucket]
        known = row > 0
        bins = np.stack([np.searchsorted(self.edges[s], stats[:, s], side="right") for s in range(k)], axis=1)
        bins[np.isnan(stats)] = BINS
        rows = self.words + np.arange(k) * (BINS + 1) + bins
        who = np.concatenate([of[known], np.repeat(np.arange(n), k)])
        order = np.argsort(who, kind="stable")
        return who[order], np.concatenate([row[known], rows.reshape(-1)])[order], np.concatenate([value[known], np.full(n * k, BIN_VALUE)])[order]

    def raw(self, who: np.ndarray, row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """bias + linear part + interactions by the sum of squares identity."""
        total = self.bias + np.bincount(who, self.weights[row] * value, n)
        for f in range(self.factors.shape[1]):
            x = self.factors[row, f] * value
            total += 0.5 * (np.bincount(who, x, n) ** 2 - np.bincount(who, x * x, n))
        return total


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(of: np.ndarray, bucket: np.ndarray, count: np.ndarray, stats: np.ndarray, label: np.ndarray) -> Model:
    """Adagrad on the log loss, in mini-batches of a seeded order."""
    n, k = stats.shape
    if not n or label.min() == label.max():
        share = label.mean() if n else 0.5
        return Model(bias=float(np.log(share + 1e-6) - np.log(1 - share + 1e-6)), edges=np.zeros((k, BINS - 1)), weights=np.zeros(1 + k * (BINS + 1)),
                     factors=np.zeros((1 + k * (BINS + 1), FACTORS)))
    texts = np.bincount(bucket, minlength=BUCKETS)
    used = np.flatnonzero(texts >= MIN_TEXTS)
    row_of = np.zeros(BUCKETS, dtype=np.int32)
    row_of[used] = np.arange(1, len(used) + 1)
    size = 1 + len(used) + k * (BINS + 1)
    rng = np.random.default_rng(SEED)
    edges = np.nanquantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    m = Model(0.0, edges, row_of, np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)), 1 + len(used))
    m.factors[0] = 0
    who, row, value = m.features(of, bucket, count, stats)
    at = np.searchsorted(who, np.arange(n + 1))
    sums_w, sums_v, sum_b = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for b in range(0, n, BATCH):
            part = order[b:b + BATCH]
            length = at[part + 1] - at[part]
            local = np.repeat(np.arange(len(part)), length)
            pick = np.repeat(at[part] - (np.cumsum(length) - length), length) + np.arange(len(local))
            r, x = row[pick], value[pick]
            error = (sigmoid(m.raw(local, r, x, len(part))) - label[part]) / len(part)
            touched, inverse = np.unique(r, return_inverse=True)
            ex = error[local] * x
            g = np.bincount(inverse, ex) + DECAY * m.weights[touched]
            sums_w[touched] += g * g
            step_w = RATE * g / np.sqrt(sums_w[touched])
            for f in range(FACTORS):
                vx = m.factors[r, f] * x
                s = np.bincount(local, vx, len(part))
                g = np.bincount(inverse, ex * (s[local] - vx)) + DECAY * m.factors[touched, f]
                sums_v[touched, f] += g * g
                m.factors[touched, f] -= RATE * g / np.sqrt(sums_v[touched, f])
            m.weights[touched] -= step_w
            sum_b += error.sum() ** 2
            m.bias -= RATE * error.sum() / np.sqrt(sum_b)
    return m


def _meta(batch: pa.RecordBatch, names: tuple[str, ...]) -> np.ndarray:
    columns = [np.array([np.nan if v is None else np.log1p(max(0.0, float(v))) for v in batch.column(c).to_pylist()]) for c in names]
    return np.stack(columns, axis=1) if columns else np.zeros((batch.num_rows, 0))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: tuple[str, ...] = (), sample: int = SAMPLE) -> Model:
    """Fit on ``sample`` rows at most: labels (doc_id, ``label`` 0 or 1; the largest if an id repeats) joined to docs (the
    row with the least hash if an id repeats)."""
    need(docs, "doc_id", "text", *metadata)
    need(labels, "doc_id", label)
    small_batches(docs.sparkSession)
    chosen = (labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("__label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select("doc_id", "text", *metadata).join(F.broadcast(chosen), "doc_id")
    rows = (rows.groupBy("doc_id", "__label").agg(F.min(F.struct(F.xxhash64("text", *metadata).alias("__hash"), "text", *metadata)).alias("__row"))
            .select("doc_id", "__label", "__row.text", *(F.col("__row")[c].alias(c) for c in metadata)))  # bounded by ``sample``

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("quality")
        for batch in batches:
            meta = _meta(batch, metadata)
            for first, texts in chunks([t or "" for t in batch.column("text").to_pylist()]):
                of, bucket, count, stats = describe(texts)
                stats = np.hstack([stats, meta[first:first + len(texts)]])
                at = pa.array(np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, len(texts)), batch.column("__label").slice(first, len(texts)).cast(pa.int32()),
                    pa.ListArray.from_arrays(at, pa.array(bucket.astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(count.astype(np.int32))),
                    pa.array(list(stats), pa.list_(pa.float64()))], names=["doc_id", "label", "bucket", "count", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"doc_id {kind}, label int, bucket array<int>, count array<int>, stats array<double>").toArrow()
    if not got.num_rows:
        k = 15 + len(metadata)
        return fit(*(np.zeros(0, dtype=np.int64),) * 3, np.zeros((0, k)), np.zeros(0))
    got = got.sort_by("doc_id")  # the fit doesn't depend on the order in which tasks end
    # flat int32 arrays straight from Arrow
    flat = lambda c: pc.list_flatten(got.column(c)).to_numpy()
    of = np.repeat(np.arange(got.num_rows, dtype=np.int32), pc.list_value_length(got.column("bucket")).to_numpy())
    bucket, count, stats, label = flat("bucket"), flat("count"), flat("stats").reshape(got.num_rows, -1), got.column("label").to_numpy().astype(float)
    del got
    return fit(of, bucket, count, stats, label)


def score(docs: DataFrame, model: Model, metadata: tuple[str, ...] = (), name: str = "score") -> DataFrame:
    """Add ``name``: the probability of label 1 for each whole text."""
    need(docs, "text", *metadata)
    small_batches(docs.sparkSession)
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most (BUCKETS + bins) x (FACTORS + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("quality")
        m = shared.value
        for batch in batches:
            meta = _meta(batch, metadata)
            for first, texts in chunks([t or "" for t in batch.column("text").to_pylist()]):
                of, bucket, count, stats = describe(texts)
                who, row, value = m.features(of, bucket, count, np.hstack([stats, meta[first:first + len(texts)]]))
                out = pa.array(sigmoid(m.raw(who, row, value, len(texts))))
                yield pa.RecordBatch.from_arrays([*batch.slice(first, len(texts)).columns, out], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
