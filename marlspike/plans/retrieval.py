"""Registered index and retrieval queries; a document is ten consecutive lines of a text."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlspike.operators import index as I
from marlspike.operators.spread import small_parts
from marlspike.plans.registry import query
from marlspike.plans.text import LINES, each_line, lines
from marlspike.session import checkpoint_root, exists, fingerprint, rename, scratch_path
from marlspike.sources.tables import table

SEARCHES = {
    "q1": ["the", "of"],
    "q2": ["der", "die"],
    "q3": ["que", "de"],
    "q4": ["tion", "with"],
    "q5": ["zzunknownzz", "the"],
    "q6": ["and", "and"],
}

TF = f"""{LINES}, w AS (SELECT doc_id, (line_no // 10)::INTEGER AS grp, unnest(t) AS term FROM toks),
    tf AS (SELECT doc_id, grp, term, count(*) AS tf FROM w GROUP BY ALL)"""
ASKED = "asked(query_id, term, n_terms) AS (VALUES " + ", ".join(
    f"('{q}', '{t}', {len(set(ts))})" for q, ts in SEARCHES.items() for t in sorted(set(ts))
) + ")"
HITS = """
    hits AS (SELECT query_id, doc_id, grp, n_terms, sum(tf)::BIGINT AS score, count(*) AS matched
             FROM tf JOIN asked USING (term) GROUP BY ALL),
    both_ops AS (SELECT query_id, 'AND' AS op, doc_id, grp, score FROM hits WHERE matched = n_terms
                 UNION ALL SELECT query_id, 'OR', doc_id, grp, score FROM hits)
"""


def _tf(spark, sf):
    return I.term_frequencies(I.line_groups(each_line(spark, sf)))


def _write_index(spark, sf, path):
    groups = I.line_groups(each_line(spark, sf))
    return I.write_index(I.block_term_frequencies(groups), path, small_parts(groups))


def stored_index(spark, sf):
    """The index of ``documents`` in the shared folder: built at the first use, then read as long as the files are the same."""
    path = f"{checkpoint_root(spark).rstrip('/')}/index-{fingerprint(table(spark, sf, 'documents'))}"
    if not exists(spark, f"{path}/skips/_SUCCESS"):
        new = scratch_path(spark, "index")
        _write_index(spark, sf, new)
        if not rename(spark, new, path):  # somebody else was faster
            return I.StoredIndex(spark, new)
    return I.StoredIndex(spark, path)


@query("idx_docgroup", f"""
    WITH {LINES} SELECT doc_id, (line_no // 10)::INTEGER AS grp, count(*) AS n_lines FROM lines GROUP BY ALL
""")
def idx_docgroup(spark, sf):
    return I.line_groups(lines(spark, sf)).groupBy("doc_id", "grp").agg(F.count(F.lit(1)).alias("n_lines"))


@query("idx_tf", f"WITH {TF} SELECT doc_id, grp, term, tf FROM tf")
def idx_tf(spark, sf):
    return _tf(spark, sf)


INDEX = f"""
    WITH {TF}, d AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
    SELECT term, df, doc_id // 4096 AS doc_block, (grp // 64)::BIGINT AS grp_block,
      string_agg(doc_id || '.' || grp || ':' || tf, ' ' ORDER BY doc_id, grp) AS postings
    FROM tf JOIN d USING (term) GROUP BY ALL
"""


def _printed(index):
    one = F.transform("postings", lambda p: F.concat(p["doc_id"].cast("string"), F.lit("."), p["grp"].cast("string"), F.lit(":"), p["tf"].cast("string")))
    return index.select("term", "df", "doc_block", "grp_block", F.array_join(one, " ").alias("postings"))


@query("idx_build", INDEX)
def idx_build(spark, sf):
    """The index, built anew and stored."""
    return _printed(_write_index(spark, sf, scratch_path(spark, "index")).lists())


@query("src_postings", INDEX)
def src_postings(spark, sf):
    """The stored index, read back."""
    return _printed(stored_index(spark, sf).lists())


@query("idx_skips", f"""
    WITH {TF} SELECT term, doc_id // 4096 AS doc_block, (grp // 64)::BIGINT AS grp_block, count(*) AS n, max(tf) AS most FROM tf GROUP BY ALL
""")
def idx_skips(spark, sf):
    """What a search knows of a block before it reads its postings."""
    return stored_index(spark, sf).skips().select("term", *I.BLOCK, "n", "most")


@query("agg_group_list", f"""
    WITH {TF} SELECT doc_id, grp, string_agg(term || ':' || tf, ' ' ORDER BY term) AS terms FROM tf GROUP BY ALL
""")
def agg_group_list(spark, sf):
    """Sorted term list of each ten-line document."""
    one = F.transform(F.sort_array(F.collect_list(F.struct("term", "tf"))),
                      lambda p: F.concat(p["term"], F.lit(":"), p["tf"].cast("string")))
    return _tf(spark, sf).groupBy("doc_id", "grp").agg(F.array_join(one, " ").alias("terms"))


@query("ret_and", f"""
    WITH {TF}, {ASKED}, {HITS} SELECT query_id, doc_id, grp, score FROM both_ops WHERE op = 'AND'
""")
def ret_and(spark, sf):
    return I.search(stored_index(spark, sf), SEARCHES, "AND")


@query("jn_postings_and", f"""
    WITH {TF} SELECT a.doc_id, a.grp, a.tf AS tf_the, b.tf AS tf_of
    FROM tf a JOIN tf b ON a.doc_id = b.doc_id AND a.grp = b.grp WHERE a.term = 'the' AND b.term = 'of'
""")
def jn_postings_and(spark, sf):
    """Two posting lists matched on the document: one row per document and term, so no group to pair up."""
    tf = _tf(spark, sf)
    a = tf.filter("term = 'the'").select("doc_id", "grp", F.col("tf").alias("tf_the"))
    b = tf.filter("term = 'of'").select("doc_id", "grp", F.col("tf").alias("tf_of"))
    return a.join(b, ["doc_id", "grp"])


@query("ret_or", f"""
    WITH {TF}, {ASKED}, {HITS} SELECT query_id, doc_id, grp, score FROM both_ops WHERE op = 'OR'
""")
def ret_or(spark, sf):
    return I.search(stored_index(spark, sf), SEARCHES, "OR")


REPORT = f"""
    WITH {TF}, {ASKED}, {HITS},
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id, op ORDER BY score DESC, doc_id, grp)::INTEGER AS rank,
                 count(*) OVER (PARTITION BY query_id, op) AS total_hits FROM both_ops)
    SELECT query_id, op, rank, doc_id, grp, score, total_hits FROM r WHERE rank <= 10
"""


@query("ret_rank_top10", REPORT)
def ret_rank_top10(spark, sf):
    return I.report(stored_index(spark, sf), SEARCHES)


@query("ret_top10_blocks", f"""
    WITH {TF}, {ASKED}, {HITS},
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, grp)::INTEGER AS rank FROM hits)
    SELECT query_id, rank, doc_id, grp, score FROM r WHERE rank <= 10
""")
def ret_top10_blocks(spark, sf):
    """Top ten for any term, without the blocks that cannot reach it."""
    return I.top_k(stored_index(spark, sf), SEARCHES)


@query("snk_query_report", REPORT)
def snk_query_report(spark, sf):
    """The retrieval report written as a table and read back."""
    path = scratch_path(spark, "query-report")
    ret_rank_top10(spark, sf).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("doc_df_normalised_score", f"""
    WITH {TF}, {ASKED}, d AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
    SELECT query_id, doc_id, grp, round(sum(tf / df), 9) AS score
    FROM tf JOIN d USING (term) JOIN asked USING (term) GROUP BY ALL
""")
def doc_df_normalised_score(spark, sf):
    hits = I.search(stored_index(spark, sf), SEARCHES, "OR", score="normalised")
    return hits.withColumn("score", F.round("score", 9))
