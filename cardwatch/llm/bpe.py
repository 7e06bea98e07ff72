"""BPE encoding and decoding.

Encoding splits a text into words as byte-level BPE does, then each distinct word is encoded once per
worker. An Aho-Corasick automaton over all tokens gives the longest token at each position; a chain of
tokens is the BPE result exactly when every two neighbours are compatible, that is when merging the bytes
of both would end with these two tokens again. Positions from which no compatible chain reaches the end
are remembered, so a word takes linear time. Decoding gathers the tokens' bytes by an offset table.

Null text counts as empty; an empty text has no ids. A special token's string inside a text becomes its
id. Rows are handled one by one, so repeated rows, ties and extra columns change nothing; a column with the
name of a result is replaced; an empty table gives an empty table. Texts may have any length; memory grows with the longest text, not with a partition.
"""

from __future__ import annotations

import array
import hashlib
import itertools
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cardwatch.llm.common import BREAK, OTHER, SEP, SPACE, char_classes, chunks, join_texts, kept, need, number_spans, small_batches

#: Words of more code points aren't kept in the worker's memory.
LONGEST_KEPT = 64
#: Characters of text whose words are numbered together; more of them would repeat in a larger part, at more memory.
CHUNK = 1_000_000
#: Distinct words that a worker keeps.
WORDS_KEPT = 600_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else 256 and on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = itertools.count(256)
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens of a byte-level BPE file, numbered by merge order inside; ``outer`` has the file's ids."""

    def __init__(self, text: str) -> None:
        model = json.loads(text)
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        letters = byte_letters()
        number = {c: b for b, c in enumerate(letters)}
        byte_of = {c: bytes([b]) for b, c in enumerate(letters)}
        names = list(letters)
        self.left, self.right = [-1] * 256, [-1] * 256
        self.joined: dict[tuple[int, int], int] = {}
        for pair in merges:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            made = number.setdefault(a + b, len(names))
            self.joined.setdefault((number[a], number[b]), made)
            if made == len(names):
                names.append(a + b)
                self.left.append(number[a])
                self.right.append(number[b])
        self.content = [b"".join(byte_of[c] for c in name) for name in names]
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.outer = np.array([*(vocab[name] for name in names), *self.special.values()], dtype=np.uint32)
        self.length = [len(c) for c in self.content]
        known = {c: i for i, c in enumerate(self.content)}
        self.shorter = [next((known[c[:n]] for n in range(len(c) - 1, 0, -1) if c[:n] in known), -1) for c in self.content]
        self.automaton = ahocorasick.Automaton()
        for i, c in enumerate(self.content):
            self.automaton.add_word(c.decode("latin-1"), i)
        self.automaton.make_automaton()
        self._pairs: dict[tuple[int, int], bool] = {}

        by_id = {int(o): c for o, c in zip(self.outer, self.content, strict=False)} | {i: s.encode() for s, i in self.special.items()}
        sizes = np.array([len(by_id.get(i, b"")) for i in range(max(by_id) + 1)], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.bytes = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(len(sizes))), dtype=np.uint8)

    def compatible(self, a: int, b: int) -> bool:
        """True if BPE over the bytes of both tokens ends with just these two."""
        found = self._pairs.get((a, b))
        if found is None:
            if len(self._pairs) > 1_000_000:
                self._pairs.clear()
            found = self._pairs[a, b] = self._stay_apart(a, b)
        return found

    def _stay_apart(self, a: int, b: int) -> bool:
        # Undo merges at the border, the latest first: no pair seen there may merge before what was undone.
        before = len(self.content)
        while True:
            if self.joined.get((a, b), before) < before:
                return False
            if max(a, b) < 256:
                return True
            if a > b:
                before, a = a, self.right[a]
            else:
                before, b = b + 1, self.left[b]

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one word, given as latin-1 text of its bytes."""
        tokens = [t for _, t in self.automaton.iter_long(word)]
        known = self._pairs.get
        for k, pair in enumerate(itertools.pairwise(tokens), 1):
            ok = known(pair)
            if not (self.compatible(*pair) if ok is None else ok):
                return self._backtrack(word, tokens[:k], tokens[k])
        return tokens

    def _backtrack(self, word: str, tokens: list[int], t: int) -> list[int]:
        """Go on from a compatible chain of longest tokens behind which the longest one, ``t``, doesn't fit."""
        size, length, shorter, known = len(word), self.length, self.shorter, self._pairs.get
        longest = [0] * size
        for end, token in self.automaton.iter(word):  # a start's longer tokens come later
            longest[end - length[token] + 1] = token
        dead = bytearray(size + 1)
        at = sum([length[x] for x in tokens])
        last = tokens[-1]
        while at < size:
            while t >= 0:
                if not dead[at + length[t]]:
                    if last < 0:
                        break
                    ok = known((last, t))
                    if self.compatible(last, t) if ok is None else ok:
                        break
                t = shorter[t]
            if t >= 0:
                tokens.append(t)
                last = t
                at += length[t]
                t = longest[at] if at < size else -1
            else:
                dead[at] = 1
                gone = tokens.pop()
                last = tokens[-1] if tokens else -1
                at -= length[gone]
                t = shorter[gone]
        return tokens


class Encoder:
    """Encodes lists of texts; keeps the words it has met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.marks = {s: chr(0xD801 + k) for k, s in enumerate(vocabulary.special)}
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.first, self.count, self.ids = array.array("q"), array.array("q"), array.array("I")

    def borders(self, points: np.ndarray) -> np.ndarray:
        """Starts of the words: a run of letters, numbers or other signs with one blank before it, the
        short forms 's 't 'm 'd 're 've 'll, or white space without that blank; every break by itself."""
        kind = char_classes()[points]
        blank = points == 32
        before = np.concatenate([[np.uint8(BREAK)], kind[:-1]])
        after = np.concatenate([kind[1:], [np.uint8(BREAK)]])
        white = kind == SPACE
        start = kind != before
        start[1:] &= ~(blank[:-1] & (kind[1:] < SPACE))
        start |= white & (after < SPACE)
        start |= kind == BREAK
        quote = np.flatnonzero(points == 39)
        if len(quote):
            quote = quote[(before[quote] != OTHER) & start[quote]]
            padded = np.concatenate([points, np.zeros(3, dtype=points.dtype)])
            one, two = padded[quote + 1], padded[quote + 2]
            single = np.isin(one, [ord(c) for c in "stmd"])
            double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            for hit, size in ((single, 2), (double, 3)):
                at = quote[hit]
                start[at + 1] = False
                start[at[at + size < len(points)] + size] = True
        return np.flatnonzero(start)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids begin and the last one's end."""
        ids, ends, total = [], [np.zeros(1, dtype=np.int64)], 0
        for _, part in chunks(texts, CHUNK):
            got, at = self._encode(part)
            ids.append(got)
            ends.append(at + total)
            total += len(got)
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), np.concatenate(ends)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        marked = texts
        for s, mark in self.marks.items():
            marked = [t.replace(s, mark) if s in t else t for t in marked]
        points = join_texts(marked)
        starts = self.borders(points)
        ends = np.append(starts[1:], len(points))
        if len(self.slot) > WORDS_KEPT:
            self._forget()
        index, which = number_spans(points, starts, ends)
        whole, own = SEP.join([*marked, ""]), len(self.v.content) - 0xD801
        spans = zip(starts[index].tolist(), ends[index].tolist(), strict=True)
        keys = [whole[a:b] for a, b in spans]
        slots = [self.slot.get(k, -1) for k in keys]
        fresh = [i for i, s in enumerate(slots) if s < 0]
        for i in fresh:
            word = keys[i]
            if "\ud800" <= word[0] <= "\udfff":
                found = [ord(word) + own] if word != SEP else []
            else:
                found = self.v.encode_word(word if word.isascii() else word.encode().decode("latin-1"))
            slots[i] = len(self.first)
            self.first.append(len(self.ids))
            self.count.append(len(found))
            self.ids.extend(found)
            if len(word) <= LONGEST_KEPT:
                self.slot[word] = slots[i]
        slot = np.array(slots, dtype=np.int64)
        # views of the kept arrays, gone before these grow again
        first, count = (np.frombuffer(x, dtype=np.int64)[slot][which] for x in (self.first, self.count))
        upto = np.cumsum(count)
        place = np.repeat(first - (upto - count), count)
        place += np.arange(len(place))
        ids = self.v.outer[np.frombuffer(self.ids, dtype=np.uint32)[place]]
        return ids, upto[np.flatnonzero(points[starts] == 0xD800)]


def decode(v: Vocabulary, ids: np.ndarray) -> bytes:
    """Bytes of the ids, gathered by the offset table."""
    first = v.offsets[ids]
    size = v.offsets[ids.astype(np.int64) + 1] - first
    place = np.repeat(first - (np.cumsum(size) - size), size)
    place += np.arange(len(place))
    return v.bytes[place].tobytes()


def loaded(text: str) -> tuple[Vocabulary, Encoder]:
    """The tables of a tokenizer file, built once per worker, until it does other work."""
    tables = kept("bpe")
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in tables:
        v = Vocabulary(text)
        tables[key] = (v, Encoder(v))
    return tables[key]


def read_tokenizer(df: DataFrame, path: str):
    """Broadcast of the tokenizer file (about 1.5 MB): executors need no copy of it."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


#: Characters of text that a worker holds as ids at once.
SLICE = 4_000_000


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    texts = [t or "" for t in batch.column(text).to_pylist()]
    for first, part in chunks(texts, SLICE):
        yield batch.slice(first, len(part)), part


def encode(df: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add the array<int> column ``ids``; with ``decoded``, also what the ids decode to (in the same worker)."""
    need(df, text)
    small_batches(df.sparkSession)
    df = df.drop(*(c for c in (ids, decoded) if c and c != text))
    file = read_tokenizer(df, tokenizer_path)
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]
    fields += [T.StructField(decoded, T.StringType(), False)] if decoded else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, encoder = loaded(file.value)
        for batch in batches:
            for part, texts in _slices(batch, text):
                got, at = encoder.encode(texts)
                columns = [*part.columns, pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(got.view(np.int32)))]
                if decoded:
                    columns.append(pa.array([decode(v, got[a:b]).decode("utf-8", "replace") for a, b in itertools.pairwise(at.tolist())], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *(f.name for f in fields)])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def decode_column(df: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the string column ``text`` that the array column ``ids`` decodes to; null ids give empty text."""
    need(df, ids)
    small_batches(df.sparkSession)
    df = df.drop(text)
    file = read_tokenizer(df, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, _ = loaded(file.value)
        for batch in batches:
            rows = [decode(v, np.array(x or [], dtype=np.uint32)).decode("utf-8", "replace") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.string())], names=[*batch.schema.names, text])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(text, T.StringType(), False)]))
