"""Inverted index in bounded blocks, stored once, and ranked boolean retrieval over it.

A document is a group of ``lines_per_doc`` consecutive lines. Posting lists are cut by
document range: a block covers a fixed range of documents and so has a fixed largest
size, however common its term is. All terms are cut at the same borders, so a query is
answered block by block.

A stored index has two tables, each partitioned by a hash bucket of the term and sorted
by term inside a bucket. ``postings`` holds the blocks. ``skips`` has, per block, only the
number of postings and the largest term frequency; document frequencies are sums over it,
and a top-k search reads it first to leave out blocks that cannot reach the top.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlspike.functions import tokens as T
from marlspike.operators.spread import gathered
from marlspike.session import cut_lineage

# Fixed value: consecutive lines that make up one document.
LINES_PER_DOC = 10

DOCS_PER_SEGMENT = 4096
GROUPS_PER_SEGMENT = 64
#: Documents whose postings are listed in one task; divides DOCS_PER_SEGMENT.
DOCS_PER_STRETCH = 512
#: Buckets that terms are hashed to; a query reads those of its terms.
BUCKETS = 16
BLOCK = ["doc_block", "grp_block"]


def line_groups(lines: DataFrame, lines_per_doc: int = LINES_PER_DOC) -> DataFrame:
    """``(doc_id, grp, line)`` with ``grp`` the block of ``lines_per_doc`` lines."""
    return lines.select("doc_id", F.floor(F.col("line_no") / lines_per_doc).cast("int").alias("grp"), "line")


def term_frequencies(groups: DataFrame) -> DataFrame:
    """``doc_id, grp, term, tf``. The lines are brought together by document, so that no term is shuffled."""
    return _counted(gathered(groups, "doc_id", "grp"), ["doc_id", "grp"])


def _counted(groups: DataFrame, keys: list[str]) -> DataFrame:
    return T.each(groups, keys, T.letters(F.col("line")), "term").groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(tf: DataFrame) -> DataFrame:
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def block_term_frequencies(groups: DataFrame) -> DataFrame:
    """``*BLOCK, stretch, doc_id, grp, term, tf``, the documents of a stretch of a block in one partition."""
    placed = groups.withColumns({**_block(), "stretch": F.floor(F.col("doc_id") / DOCS_PER_STRETCH)})
    keys = [*BLOCK, "stretch"]
    return _counted(gathered(placed, *keys), [*keys, "doc_id", "grp"])


def _block() -> dict[str, Column]:
    return {"doc_block": F.floor(F.col("doc_id") / DOCS_PER_SEGMENT), "grp_block": F.floor(F.col("grp") / GROUPS_PER_SEGMENT)}


def blocks(tf: DataFrame, parts: int | None = None) -> DataFrame:
    """``bucket, term, doc_block, grp_block, n, most, postings``: one row a block, postings sorted by document.

    Postings are listed per stretch first. Rows of ``block_term_frequencies`` lie together by
    stretch, so only lists are shuffled, to about ``parts`` partitions, by bucket and by a hash
    of term and document block: the blocks of a very common term lie in many partitions.
    """
    spark, keys = tf.sparkSession, ["bucket", "term", *BLOCK]
    if "stretch" not in tf.columns:
        tf = tf.withColumns({**_block(), "stretch": F.floor(F.col("doc_id") / DOCS_PER_STRETCH)})
    shares = -(-(parts or int(spark.conf.get("spark.sql.shuffle.partitions"))) // BUCKETS)
    # a row holds its numbers in three plain arrays
    lists = tf.groupBy(*BLOCK, "stretch", "term").agg(
        F.max("tf").alias("most"), F.sort_array(F.collect_list(F.struct("doc_id", "grp", "tf"))).alias("p")
    ).select(*BLOCK, "term", "most", "stretch", "p.doc_id", "p.grp", "p.tf", bucket(F.col("term")).alias("bucket"),
             F.pmod(F.xxhash64("term", "doc_block"), F.lit(shares)).alias("share"))
    stretches = F.sort_array(F.collect_list(F.struct("stretch", "doc_id", "grp", "tf")))
    postings = F.flatten(F.transform(stretches, lambda s: F.arrays_zip(s["doc_id"].alias("doc_id"), s["grp"].alias("grp"), s["tf"].alias("tf"))))
    return (
        lists.repartition(BUCKETS * shares, "bucket", "share").groupBy("share", *keys)
        .agg(F.max("most").alias("most"), postings.alias("postings"))
        .select(*keys, F.size("postings").cast("long").alias("n"), "most", "postings")
    )


@dataclass(frozen=True)
class StoredIndex:
    """An index in a folder."""

    spark: SparkSession
    path: str

    def postings(self, terms: Sequence[str] | None = None) -> DataFrame:
        return self._read("postings", terms)

    def skips(self, terms: Sequence[str] | None = None) -> DataFrame:
        return self._read("skips", terms)

    def _read(self, name: str, terms: Sequence[str] | None) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/{name}")
        if terms is None:
            return rows
        terms = sorted(set(terms))
        wanted = self.spark.createDataFrame([(t,) for t in terms], "term string").select(bucket(F.col("term")).alias("b")).distinct()
        # the buckets prune folders, the terms row groups
        return rows.filter(F.col("bucket").isin([r["b"] for r in wanted.collect()]) & F.col("term").isin(terms))

    def lists(self) -> DataFrame:
        """Every block with its term's document frequency."""
        df = cut_lineage(self.skips().groupBy("term").agg(F.sum("n").alias("df")))
        # the counts are materialised, so that the join can be split at a term with very many blocks
        return self.postings().join(df, "term").select("term", "df", *BLOCK, "postings")


def write_index(tf: DataFrame, path: str, parts: int | None = None) -> StoredIndex:
    """Store the index of ``tf`` under ``path``; an index already there is replaced. ``parts``: see ``blocks``."""
    spark, order = tf.sparkSession, ["bucket", "term", *BLOCK]
    blocks(tf, parts).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    skips = spark.read.parquet(f"{path}/postings").select("bucket", "term", *BLOCK, "n", "most")
    skips.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/skips")
    return StoredIndex(spark, path)


def query_terms(spark: SparkSession, queries: dict[str, Sequence[str]]) -> DataFrame:
    """``(query_id, term, n_terms)`` with repeated terms of a query counted once."""
    rows = [(q, t, len(set(ts))) for q, ts in queries.items() for t in sorted(set(ts))]
    return spark.createDataFrame(rows, "query_id string, term string, n_terms int")


def _asked(index: StoredIndex, queries: dict[str, Sequence[str]], normalised: bool) -> DataFrame:
    """Query terms with what a single occurrence is worth."""
    asked = query_terms(index.spark, queries)
    if not normalised:
        return asked.withColumn("df", F.lit(1).cast("long"))
    counts = index.skips([t for ts in queries.values() for t in ts]).groupBy("term").agg(F.sum("n").alias("df"))
    return asked.join(counts, "term")


def _scored(blocks: DataFrame, asked: DataFrame, normalised: bool) -> DataFrame:
    """``query_id, *BLOCK, n_terms, doc_id, grp, score, matched`` of every document with a term.

    Blocks are shuffled whole, by query and block; all later grouping stays in that partitioning.
    The query terms are as many as the caller wrote, so they are broadcast.
    """
    value = F.col("p.tf") / F.col("df") if normalised else F.col("p.tf")
    together = blocks.join(F.broadcast(asked), "term").repartition("query_id", *BLOCK)
    return (
        together.select("query_id", *BLOCK, "n_terms", "df", F.explode("postings").alias("p"))
        .groupBy("query_id", *BLOCK, "n_terms", "p.doc_id", "p.grp")
        .agg(F.sum(value).alias("score"), F.count(F.lit(1)).alias("matched"))
    )


def search(index: StoredIndex, queries: dict[str, Sequence[str]], op: str, score: str = "tf") -> DataFrame:
    """``(query_id, doc_id, grp, score)`` of documents with all or any of the terms.

    ``score`` is the sum of tf, or of tf / df with ``"normalised"``.
    """
    if op not in ("AND", "OR"):
        raise ValueError(op)
    normalised = score == "normalised"
    found = index.postings([t for ts in queries.values() for t in ts])
    hits = _scored(found, _asked(index, queries, normalised), normalised)
    if op == "AND":
        hits = hits.filter(F.col("matched") == F.col("n_terms"))
    return hits.select("query_id", "doc_id", "grp", "score")


def block_report(index: StoredIndex, queries: dict[str, Sequence[str]], k: int) -> DataFrame:
    """``query_id, op, hits, best``: per query, operator and block the number of hits and its first ``k``.

    Both operators come from one scoring, in one pass over the postings.
    """
    hits = _scored(index.postings([t for ts in queries.values() for t in ts]), _asked(index, queries, False), False)
    both = F.col("matched") == F.col("n_terms")
    entry = F.struct((-F.col("score")).alias("minus"), "doc_id", "grp")
    found = hits.groupBy("query_id", *BLOCK).agg(
        F.count(F.lit(1)).alias("or_hits"), F.count_if(both).alias("and_hits"),
        F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("or_best"),
        F.slice(F.sort_array(F.collect_list(F.when(both, entry))), 1, k).alias("and_best"))
    ops = F.array(*[F.struct(F.lit(op).alias("op"), F.col(f"{op.lower()}_hits").alias("hits"), F.col(f"{op.lower()}_best").alias("best"))
                    for op in ("AND", "OR")])
    return found.select("query_id", F.explode(ops).alias("o")).select("query_id", "o.*").filter("hits > 0")


def _ranked(entries: DataFrame, k: int) -> DataFrame:
    """First ``k`` entries (``query_id, op, e``) of every query and operator."""
    order = Window.partitionBy("query_id", "op").orderBy("e.minus", "e.doc_id", "e.grp")
    return entries.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "op", "rank", "e.doc_id", "e.grp", (-F.col("e.minus")).alias("score"))


def report(index: StoredIndex, queries: dict[str, Sequence[str]], k: int = 10) -> DataFrame:
    """First ``k`` hits of every query under both operators, with the total number of hits."""
    blocks = cut_lineage(block_report(index, queries, k))
    totals = blocks.groupBy("query_id", "op").agg(F.sum("hits").alias("total_hits"))
    best = _ranked(blocks.select("query_id", "op", F.explode("best").alias("e")), k)
    return best.join(totals, ["query_id", "op"]).select("query_id", "op", "rank", "doc_id", "grp", "score", "total_hits")


def surviving_blocks(index: StoredIndex, queries: dict[str, Sequence[str]], k: int) -> DataFrame:
    """``query_id, *BLOCK``: the blocks that may hold one of the first ``k`` hits of a query for any of its terms.

    A block's documents score at most the sum of its terms' largest frequencies, and one
    of them at least the largest. The k-th best of the latter is a score that k documents
    of different blocks reach, so blocks whose bound lies below it are left out.
    """
    asked = query_terms(index.spark, queries)
    bounds = index.skips([t for ts in queries.values() for t in ts]).join(F.broadcast(asked), "term").groupBy("query_id", *BLOCK).agg(
        F.sum("most").alias("bound"), F.max("most").alias("reached"))
    order = Window.partitionBy("query_id").orderBy(F.desc("reached"), *BLOCK)
    floor = (
        bounds.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)
        .groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("reached")).otherwise(0).alias("floor"))
    )
    # one row a query
    return bounds.join(F.broadcast(floor), "query_id").filter(F.col("bound") >= F.col("floor")).select("query_id", *BLOCK)


def top_k(index: StoredIndex, queries: dict[str, Sequence[str]], k: int = 10) -> DataFrame:
    """First ``k`` documents of every query by the sum of term frequencies, any term: ``query_id, rank, doc_id, grp, score``.

    Only blocks that can reach the first ``k`` are scored, in one pass over the postings.
    """
    left = surviving_blocks(index, queries, k).join(F.broadcast(query_terms(index.spark, queries)), "query_id")
    found = index.postings([t for ts in queries.values() for t in ts]).join(left, ["term", *BLOCK])
    hits = (
        found.repartition("query_id", *BLOCK).select("query_id", *BLOCK, F.explode("postings").alias("p"))
        .groupBy("query_id", *BLOCK, "p.doc_id", "p.grp").agg(F.sum("p.tf").alias("score"))
    )
    entries = hits.select("query_id", F.lit("OR").alias("op"), F.struct((-F.col("score")).alias("minus"), "doc_id", "grp").alias("e"))
    return _ranked(entries, k).drop("op")
