"""One query per corpus operator, over whole tables; oracles where SQL can express the rows."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from marlspike.llm import (
    bpe, burst_trie, langid, license_scan, ngram_join, oracle_sql, packing, preference, quality_rules, repair, sharding, suffix_dedup, vector_links, warc)
from marlspike.llm.scratch import stored
from marlspike.llm.streamed import joined_sha256
from marlspike.session import scratch_path
from marlspike.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def oracle(sql: str) -> Callable:
    """Register DuckDB SQL for the rows of a query."""
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        ORACLES[fn.__name__] = textwrap.dedent(sql).strip()
        return fn
    return add


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judged(docs, table(spark, sf_dir, "labels")).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = langid.fit(docs, where=~held_out)
    return langid.predict(docs.select("doc_id", "text"), model).select(
        F.col("row.doc_id").alias("doc_id"), "lang_pred", "score").withColumn("held_out", held_out)


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    own = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.decode(bpe.encode(docs, *own), *own).select(
        F.col("row.doc_id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), n=4, percent=85)


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.links(table(spark, sf_dir, "embeddings"))


@query
@oracle("""
    WITH stop AS (SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS t
                  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    cut AS (SELECT conv_id, t, list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')) AS n FROM stop),
    conv AS (SELECT conv_id, list_transform(t[1:n], lambda x: {'role': coalesce(x.role, ''), 'text': coalesce(x.text, '')}) AS turns FROM cut WHERE n IS NOT NULL),
    num AS (SELECT *, row_number() OVER (ORDER BY conv_id) - 1 AS rn, count(*) OVER () AS total FROM conv),
    pair AS (SELECT a.conv_id, a.turns[1:len(a.turns) - 1] AS shared, a.turns[len(a.turns)] AS c, b.turns[len(b.turns)] AS r
             FROM num a JOIN num b ON b.rn = (a.rn + 1) % a.total WHERE a.total > 1),
    split AS (SELECT conv_id, c = r AS same, CASE WHEN c = r THEN list_append(shared, c) ELSE shared END AS p, c, r FROM pair)
    SELECT conv_id AS pair_id, CAST(len(p) AS BIGINT) AS n_prompt_turns, same,
        coalesce(array_to_string(list_transform(p, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), ''), '') AS prompt,
        CASE WHEN same THEN '' ELSE '<|assistant|>' || chr(10) || c.text || '<|end|>' || chr(10) END AS chosen,
        CASE WHEN same THEN '' ELSE '14+' || CAST(length(c.text) + 8 AS VARCHAR) END AS chosen_mask,
        CASE WHEN same THEN '' ELSE '<|assistant|>' || chr(10) || r.text || '<|end|>' || chr(10) END AS rejected,
        CASE WHEN same THEN '' ELSE '14+' || CAST(length(r.text) + 8 AS VARCHAR) END AS rejected_mask
    FROM split
""")
def op3_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.swapped_replies(table(spark, sf_dir, "conversations"))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("+", s["start"].cast("string"), s["length"].cast("string"))), ",")
    return preference.format_pairs(pairs).withColumns({c: spans(c) for c in ("chosen_mask", "rejected_mask")})


@query
@oracle(oracle_sql.TRIE)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = burst_trie.rebuilt(table(spark, sf_dir, "conversations"))
    return burst_trie.nodes(rebuilt)


@query
@oracle(oracle_sql.SHARDS)
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    done = sharding.sharded(docs, 8, group=F.col("text"), order=F.col("doc_id"), size=size)
    return done.select(
        F.col("row.doc_id").alias("doc_id"), "size", F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
@oracle(oracle_sql.REPAIR)
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    rows = repair.numbered(repair.damaged(given))
    reports = stored(repair.report(rows), "reports")
    turns = repair.repaired(rows, reports).select("conv_id", "position", F.concat("role", F.lit(":"), "text").alias("line"))
    found = reports.join(repair.gaps(rows).withColumnRenamed("conv_id", "g"), F.col("conv_id").eqNullSafe(F.col("g")))
    shas = joined_sha256(turns, "conv_id", "position", "line", "\n").withColumnRenamed("conv_id", "s")
    found = found.join(shas, F.col("conv_id").eqNullSafe(F.col("s")), "left").drop("g", "s", "rn", "n").withColumnRenamed("conv_id", "c")
    longs = ["gaps", *repair.COUNTS, "cost"]
    return given.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in longs], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
