import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cardwatch.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tables():
    with open(PATH, encoding="utf-8") as f:
        return bpe.loaded(f.read())


def check(tables, library, texts):
    v, encoder = tables
    ids, at = encoder.encode(texts)
    for i, t in enumerate(texts):
        expected = library.encode(t, add_special_tokens=False).ids
        got = ids[at[i]:at[i + 1]]
        assert got.tolist() == expected, t
        assert bpe.decode(v, got).decode("utf-8", "replace") == library.decode(expected, skip_special_tokens=False)


def test_hard_texts(tables, library):
    check(tables, library, ["", " ", "  ", "a's b's 's\n's 'sx 'rex 've'll'l !'s ''s", "  a   b \n\n c\t\t", "　 a b", "abc<|endoftext|>def<|endoftext|>",
                            "12½③ a1b2", "a" * 3000, "ab" * 300 + " " * 50, " \n\n a\r\nb", "'S 'LL don't we're", "\x00\x01", "'", "''", "'r", "a'", "zqxj" * 500])


words = st.text(st.sampled_from("abcdeinorst 'éñ\n1!_<|>"), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40).filter(lambda t: not any(0xD800 <= ord(c) < 0xE000 for c in t)), words), max_size=5))
def test_random_texts(tables, library, texts):
    check(tables, library, texts)


def test_compatibility_is_bpe(tables, library):
    """A pair is compatible exactly if BPE over its joined bytes gives the pair again."""
    v, _ = tables
    rng = np.random.default_rng(1)
    letters = [i for i, c in enumerate(v.content) if c.isascii() and c.isalpha()]
    for a, b in rng.choice(letters, (400, 2)):
        joined = (v.content[a] + v.content[b]).decode()
        expected = library.encode(joined, add_special_tokens=False).ids == [int(v.outer[a]), int(v.outer[b])]
        assert v.compatible(int(a), int(b)) == expected


def test_operator_on_odd_rows(docs, odd, library):
    table = docs(odd).withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")
    rows = bpe.encode(table, PATH, decoded="decoded").collect()
    assert len(rows) == len(odd)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", tuple(r.ids), r.decoded) for r in rows)
    assert got == sorted((i is None, i or 0, t or "", tuple(library.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in odd)
    again = bpe.decode_column(bpe.encode(table, PATH).drop("text"), PATH, text="text").collect()
    assert sorted(r.text for r in again) == sorted(t or "" for _, t in odd)


def test_words_with_one_hash(tables, library, monkeypatch):
    """Long unequal words that share a polynomial hash; also if all hashes are equal."""
    from cardwatch.llm import common
    from tests.llm.test_near_dedup import mirror

    texts = [t for n in (512, 1024, 2048, 4096, 8192) for w in mirror(n) for t in (w, f"x {w} {w}")]
    check(tables, library, texts)
    monkeypatch.setattr(common, "_quick_hashes", lambda p, s, e: np.zeros(len(s), dtype=np.uint64))
    check(tables, library, [*texts[:8], "a b ab ba a b", "", " ", "é e é"])


def test_empty_table(docs):
    assert bpe.encode(docs([]), PATH, decoded="d").collect() == []


def test_query(spark, sf_small, library):
    from cardwatch.llm.queries import op2_bpe

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = op2_bpe(spark, sf_small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
