"""Registered queries of the training-data operators, on the given tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import (bpe, chat, embedding_dedup, exact_dedup, filter_audit, html_text, licences, near_dedup, packing, quality, sharding,
                           token_counts, turn_repair)
from cardwatch.llm.common import stage
from cardwatch.session import scope_of, shared_path

TOKENIZER, COUNTED = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A text of more tokens is over the limit.
TOKEN_LIMIT = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Numeric columns of ``documents`` that a score may use.
METADATA = ("n_chars",)
HELD_OUT = "coalesce(crc32(CAST(doc_id AS STRING)) % 5 = 0, true)"


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Fitted on labelled rows whose crc32 of the id isn't divisible by 5."""
    return quality.train(docs, table(spark, sf_dir, "labels").where(f"NOT {HELD_OUT}"), metadata=METADATA)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", *METADATA)
    scored = quality.score(docs, quality_model(spark, docs, sf_dir), METADATA)
    return scored.selectExpr("doc_id", f"{HELD_OUT} AS held_out", "score", "CAST(score >= 0.3 AS INT) AS predicted")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path(TOKENIZER), decoded="decoded").drop("text")
    return coded.selectExpr("doc_id", "CAST(size(ids) AS BIGINT) AS n_tokens", "sha2(array_join(ids, ','), 256) AS ids_sha256",
                            "sha2(decoded, 256) AS decoded_sha256")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("keep_hash")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents")).drop("keep_id", "keep_hash")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), licences.train(spark))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packing.pack(stage(cut, "pieces")).drop("lane")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    nodes = stage(chat.chain(turns.unionByName(more)), "turns")
    return chat.digests(chat.format_branches(nodes)).drop("leaf")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache belongs to the corpus: another run over the same tables finds its counts there."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cache = shared_path(spark, "llm-cache", "token-counts", scope_of(sf_dir))
    return token_counts.count_tokens(docs, public_tokenizers.path(COUNTED), cache).selectExpr("doc_id", "n_bytes", "n_tokens", f"n_tokens > {TOKEN_LIMIT} AS over_limit")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    audits, repaired = turn_repair.repair(turn_repair.damage(turns))
    hashes = turn_repair.digests(repaired)
    out = turns.select(F.col("conv_id").alias("id")).distinct()
    for other in (audits, hashes):
        out = out.join(other, F.expr("id <=> conv_id"), "left").drop("conv_id")
    counts = [f"coalesce({c}, 0L) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.selectExpr("id AS conv_id", *counts, "coalesce(audit, '') AS audit", "coalesce(repaired_sha256, sha2('', 256)) AS repaired_sha256")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


REGISTRY = {
    "op1_quality": op1_quality,
    "op2_bpe": op2_bpe,
    "op3_sharding": op3_sharding,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_licences": op7_licences,
    "op8_packing": op8_packing,
    "op9_chat": op9_chat,
    "op10_html": op10_html,
    "op11_token_counts": op11_token_counts,
    "op12_turn_repair": op12_turn_repair,
    "op13_filter_audit": op13_filter_audit,
}
ORACLE: dict[str, str] = {
    "op4_exact_dedup": r"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
             g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
                          count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op6_embedding_dedup": """
        WITH RECURSIVE v AS (
          SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
          WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reached AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT r.vec_id, links.y FROM reached r JOIN links ON links.x = r.c),
        degrees AS (SELECT x, count(*) AS n FROM links GROUP BY x)
        SELECT vec_id, coalesce(max(n), 0) AS n_links, min(c) AS component_id, vec_id = min(c) AS kept
        FROM reached LEFT JOIN degrees ON x = vec_id GROUP BY vec_id""",
    "op9_chat": r"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        e AS (SELECT *, regexp_replace(regexp_replace(text, '(\\*)(###|</turn>)', '\1\1\\\2', 'g'), '(\\+)$', '\1\1') AS escaped FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('### ' || role || chr(10) || escaped || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op12_turn_repair": r"""
        WITH RECURSIVE bits AS (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) AS c FROM range(256) r(i)),
        tab AS (SELECT list(c ORDER BY i) AS tab FROM bits),
        k AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
        h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                xor(list_reduce([4294967295] || [CAST(ord(x) AS BIGINT) FOR x IN string_split(name, '')], lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h
              FROM k, tab),
        d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS again,
                CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM h WHERE h <> 0),
        n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p, role[1] AS i,
                NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut FROM d),
        f AS (SELECT *, CASE WHEN blank THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
                             WHEN cut THEN 'truncated' ELSE '' END AS fault, lag(i) OVER (PARTITION BY conv_id ORDER BY p) || i AS pair FROM n),
        c AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
        ins(st, mid, ic, ia, ir) AS (VALUES
          (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
          (0, 2, 3, 'I', 'user:' || chr(10)), (1, 2, 3, 'I', 'user:' || chr(10)), (2, 3, 3, 'I', 'assistant:' || chr(10)), (3, 2, 3, 'I', 'user:' || chr(10)),
          (0, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
        ops(mid, op, need, nxt, oc, named) AS (VALUES
          (0, 'D', NULL, 0, 4, NULL), (1, 'D', NULL, 1, 4, NULL), (2, 'D', NULL, 2, 4, NULL), (3, 'D', NULL, 3, 4, NULL),
          (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL), (3, 'K', 'u', 2, 0, NULL),
          (0, 'R', NULL, 2, 3, 'user'), (1, 'R', NULL, 2, 3, 'user'), (2, 'R', NULL, 3, 3, 'assistant'), (3, 'R', NULL, 2, 3, 'user')),
        dp AS (
          SELECT conv_id, CAST(0 AS BIGINT) AS p, 0 AS st, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS rep FROM c
          UNION ALL
          SELECT dp.conv_id, f.p, nxt, cost + ic + oc + CASE WHEN op <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS total, audit || ia || op AS path,
                 rep || ir || CASE WHEN op = 'D' THEN '' ELSE coalesce(named, role) || ':' || text || chr(10) END
          FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.p = dp.p + 1 JOIN ins ON ins.st = dp.st JOIN ops ON ops.mid = ins.mid
          WHERE (op = 'D' OR fault IN ('', 'truncated')) AND (need IS NULL OR need = i)
          QUALIFY row_number() OVER (PARTITION BY dp.conv_id, nxt ORDER BY total, path) = 1),
        fin(st, ec, ea, er) AS (VALUES (0, 0, '', ''), (3, 0, '', ''), (2, 3, 'I', 'assistant:' || chr(10)),
          (1, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
        best AS (SELECT c.*, cost + ec AS cost, audit || ea AS audit, rep || er AS rep FROM dp JOIN c ON c.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.p = c.n
                 JOIN fin ON fin.st = dp.st QUALIFY row_number() OVER (PARTITION BY c.conv_id ORDER BY dp.cost + ec, dp.audit || ea) = 1)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(rep[:-2], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op13_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM t),
        l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                CASE WHEN len(words) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
                || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN w.doc_id > least THEN 'E' ELSE '' END AS failed
              FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
        c AS (SELECT part, good, toxic, failed, count(*) AS n FROM m GROUP BY ALL),
        f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
        o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
              WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        s AS (SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS earlier FROM o, range(1, 6) r(step)),
        x AS (SELECT part, filter_order, step, own, n, good, toxic, contains(failed, own) AS fails, failed = own AS alone,
                earlier <> '' AND regexp_matches(failed, '[' || CASE WHEN earlier = '' THEN '-' ELSE earlier END || ']') AS gone FROM c, s),
        g AS (SELECT part, filter_order, CAST(step AS INT) AS step, own,
                CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
                CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS removed,
                CAST(coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS BIGINT) AS redundant,
                CAST(coalesce(sum(n) FILTER (WHERE alone), 0) AS BIGINT) AS unique_fails,
                CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fails AND good), 0) AS BIGINT) AS good_lost,
                CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fails AND toxic), 0) AS BIGINT) AS toxic_lost FROM x GROUP BY ALL)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM g""",
}
