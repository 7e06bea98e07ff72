import os

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardwatch.llm import token_counts
from cardwatch.llm.token_counts import Tokens, count_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def batches(folder):
    top = f"{folder}/tokenizer={Tokens(PATH).version}"
    return sorted(os.listdir(top)) if os.path.exists(top) else []


def cached(spark, folder):
    return token_counts.stored(spark, folder, Tokens(PATH)).count()


def test_odd_rows_and_clashing_names(spark, docs, odd, library, scratch):
    rows = [*odd, (20, "<s>a</s><unk>"), (21, "a▁b"), (22, "a b"), (23, "\x00 a")]
    table = docs(rows).selectExpr("*", "'x' AS digest", "'y' AS its_digest", "1 AS n_tokens", "2 AS n_bytes", "3 AS count")
    out = count_tokens(table, PATH, scratch)
    assert sorted(out.columns) == sorted(table.columns)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.n_bytes, r.n_tokens, r.digest) for r in out.collect())
    assert got == sorted((i is None, i or 0, t or "", len((t or "").encode()), len(library.encode(t or "")), "x") for i, t in rows)


def test_only_misses_are_encoded(spark, docs, library, scratch, monkeypatch):
    first = [(1, "one two"), (2, "one two"), (3, "three"), (4, None)]
    count_tokens(docs(first), PATH, scratch).collect()
    assert len(batches(scratch)) == 1 and cached(spark, scratch) == 3
    count_tokens(docs(first), PATH, scratch).collect()
    assert len(batches(scratch)) == 1  # nothing was missing
    asked = []
    encode = token_counts._encode
    monkeypatch.setattr(token_counts, "_encode", lambda texts, tokens: asked.extend(r.text for r in texts.collect()) or encode(texts, tokens))
    more = [*first, (5, "four five"), (6, "four five")]
    for limit in (token_counts.BROADCAST_DIGESTS, 0):  # both ways of leaving known texts out
        monkeypatch.setattr(token_counts, "BROADCAST_DIGESTS", limit)
        asked.clear()
        rows = more if limit else [*more, (7, "six")]
        got = {r.doc_id: r.n_tokens for r in count_tokens(docs(rows), PATH, scratch).collect()}
        assert got == {i: len(library.encode(t or "")) for i, t in rows}
        assert asked == (["four five"] if limit else ["six"])


def test_stored_counts_are_used_and_repeats_are_harmless(spark, docs, scratch):
    count_tokens(docs([(1, "a b c")]), PATH, scratch).collect()
    top = f"{scratch}/tokenizer={Tokens(PATH).version}"
    rows = token_counts.stored(spark, scratch, Tokens(PATH)).withColumn("n_tokens", F.lit(1).cast("long"))
    for name in ("batch=x", "batch=y"):  # two jobs stored the same digest
        rows.write.parquet(f"{top}/{name}")
    assert [(r.doc_id, r.n_tokens) for r in count_tokens(docs([(1, "a b c")]), PATH, scratch).collect()] == [(1, 1)]


def test_versions_apart(docs, scratch):
    """Counts of another tokenizer file are never taken."""
    other = public_tokenizers.path("byte_bpe_50k.json")
    text = "special <|endoftext|> naïve text  "
    a = count_tokens(docs([(1, text)]), PATH, scratch).first().n_tokens
    b = count_tokens(docs([(1, text)]), other, scratch).first().n_tokens
    assert a == len(sentencepiece.SentencePieceProcessor(model_file=PATH).encode(text))
    assert b == len(Tokenizer.from_file(other).encode(text, add_special_tokens=False).ids) and a != b


def test_empty_table(docs, scratch):
    assert count_tokens(docs([]), PATH, scratch).collect() == [] and batches(scratch) == []


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(st.sampled_from(" ▁aé\n\tb.<s>"), max_size=30), st.text(max_size=30).filter(lambda t: not any(0xD800 <= ord(c) < 0xE000 for c in t))))
def test_normal_form_keeps_counts(library, text):
    assert library.encode(text) == library.encode(text.replace(" ", "▁"))


def test_query(spark, sf_small, library):
    from cardwatch.llm.queries import op11_token_counts

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for _ in range(2):  # without and with stored counts
        rows = op11_token_counts(spark, sf_small).collect()
        assert len(rows) == len(texts)
        for r in rows:
            n = len(library.encode(texts[r.doc_id]))
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)
