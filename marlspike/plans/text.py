"""Registered text queries. A line is one line of ``documents.text``.

The reports over co-occurrence take every pair of words of a line that are fewer than
40 tokens apart; those over neighbouring words take whole lines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marlspike.functions import tokens as T
from marlspike.operators import text as X
from marlspike.operators.spread import spread
from marlspike.plans.registry import query
from marlspike.session import cut_lineage
from marlspike.sources.tables import table

HEAD = "of"

LINES = r"""
    lines AS (
      SELECT doc_id, unnest(range(len(parts)))::INTEGER AS line_no, unnest(parts) AS line
      FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
    toks AS (SELECT doc_id, line_no, regexp_extract_all(lower(line), '[a-z]+') AS t FROM lines)
"""
BIGRAMS = """
    big AS (SELECT unnest(t[1:len(t)-1]) AS w1, unnest(t[2:len(t)]) AS w2 FROM {src} WHERE len(t) > 1),
    bc AS (SELECT w1, w2, count(*) AS count FROM big GROUP BY ALL)
"""
#: Every pair of places of a line that are fewer than 40 tokens apart.
NEAR = """
    bt AS (SELECT doc_id, line_no, unnest(t) AS tok, unnest(range(len(t))) AS i FROM {src}),
    near AS (SELECT p.doc_id, p.line_no, p.tok AS a, q.tok AS b
             FROM (SELECT *, unnest(range(1, 40)) AS d FROM bt) p
             JOIN bt q ON p.doc_id = q.doc_id AND p.line_no = q.line_no AND q.i = p.i + p.d)
"""
BASKETS = """
    b AS (SELECT doc_id, line_no, t FROM toks WHERE len(list_distinct(t)) > 1),
    m AS (SELECT tok, count(*) AS n FROM (SELECT unnest(list_distinct(t)) AS tok FROM b) GROUP BY tok),
    pc AS (SELECT x, y, count(*) AS count FROM (
             SELECT DISTINCT doc_id, line_no, least(a, b) AS x, greatest(a, b) AS y FROM near WHERE a <> b) GROUP BY ALL)
"""


def each_line(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line")).filter(F.col("line").isNotNull())


def lines(spark, sf):
    return spread(each_line(spark, sf))


# --- tokens and counts -----------------------------------------------------

@query("src_text", f"WITH {LINES} SELECT doc_id, line_no, line FROM lines")
def src_text(spark, sf):
    return lines(spark, sf)


@query("txt_tokenize", f"WITH {LINES} SELECT doc_id, line_no, array_to_string(t, ' ') AS tokens FROM toks")
def txt_tokenize(spark, sf):
    return lines(spark, sf).select(
        "doc_id", "line_no", F.array_join(T.letters_by_match(F.col("line")), " ").alias("tokens"))


@query("txt_tokenize_split", f"WITH {LINES} SELECT doc_id, line_no, array_to_string(t, ' ') AS tokens FROM toks")
def txt_tokenize_split(spark, sf):
    return lines(spark, sf).select("doc_id", "line_no", F.array_join(T.letters(F.col("line")), " ").alias("tokens"))


@query("txt_tokenize_alnum", """
    SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+'), ' ') AS tokens FROM documents
""")
def txt_tokenize_alnum(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", F.array_join(T.alphanumerics(F.col("text")), " ").alias("tokens"))


@query("txt_wordcount_topk", f"""
    WITH {LINES} SELECT token, count(*) AS count FROM (SELECT unnest(t) AS token FROM toks)
    GROUP BY token ORDER BY count DESC, token LIMIT 10
""")
def txt_wordcount_topk(spark, sf):
    return X.top_words(lines(spark, sf), 10)


@query("txt_followers", f"""
    WITH {LINES}, {BIGRAMS.format(src='toks')}
    SELECT w2 AS follower, count FROM bc WHERE w1 = '{HEAD}' AND count > 1
""")
def txt_followers(spark, sf):
    return X.followers(lines(spark, sf), HEAD)


@query("fn_string", f"""
    WITH {LINES} SELECT doc_id, line_no, trim(line, ' ') AS trimmed, left(line, 7) AS prefix,
    lower(line) AS lowered, array_to_string(t, '_') AS joined FROM toks JOIN lines USING (doc_id, line_no)
""")
def fn_string(spark, sf):
    return lines(spark, sf).select(
        "doc_id", "line_no", F.trim("line").alias("trimmed"), F.substring("line", 1, 7).alias("prefix"),
        F.lower("line").alias("lowered"), F.array_join(T.letters(F.col("line")), "_").alias("joined"))


@query("fn_array", f"""
    WITH {LINES} SELECT doc_id, line_no, len(t)::INTEGER AS n, len(list_distinct(t))::INTEGER AS n_distinct,
      array_to_string(list_sort(list_distinct(t)), ' ') AS vocabulary, greatest(len(t) - 1, 0)::INTEGER AS n_bigrams
    FROM toks
""")
def fn_array(spark, sf):
    return lines(spark, sf).select("doc_id", "line_no", T.letters(F.col("line")).alias("t")).select(
        "doc_id", "line_no", F.size("t").alias("n"), F.size(F.array_distinct("t")).alias("n_distinct"),
        F.array_join(F.sort_array(F.array_distinct("t")), " ").alias("vocabulary"),
        F.size(T.adjacent(F.col("t"))).alias("n_bigrams"))


@query("fn_map", """
    SELECT event_id, event_type || '=' || (props::JSON->>'$.k') AS entry, 1 AS size,
           (props::JSON->>'$.k')::BIGINT AS looked_up FROM events
""")
def fn_map(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = table(spark, sf, "events").select("event_id", "event_type", F.create_map("event_type", k).alias("m"))
    entries = F.transform(F.map_entries("m"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string")))
    return e.select(
        "event_id", F.array_join(entries, ",").alias("entry"), F.size("m").alias("size"),
        F.element_at("m", F.col("event_type")).alias("looked_up"))


@query("fn_hash", """
    WITH g AS (SELECT doc_id, lang || '_' || source AS gram, md5(text) AS h, sha256(text) AS s FROM documents)
    SELECT doc_id, (('0x' || substr(md5(gram), 28, 5))::BIGINT % 262144)::INTEGER AS bucket, h AS digest,
      sha256(unhex(s)) AS double_sha FROM g
""")
def fn_hash(spark, sf):
    from marlspike.functions.hashing import double_sha256, md5_bucket

    gram = F.concat_ws("_", "lang", "source")
    return table(spark, sf, "documents").select(
        "doc_id", md5_bucket(gram).alias("bucket"), F.md5("text").alias("digest"),
        double_sha256(F.hex("text")).alias("double_sha"))


# --- bigrams ---------------------------------------------------------------

@query("agg_total_pairs", f"""
    WITH {LINES} SELECT sum(greatest(len(t) - 1, 0))::BIGINT AS total FROM toks
""")
def agg_total_pairs(spark, sf):
    return X.total_bigrams(lines(spark, sf))


@query("txt_bigram_counts", f"WITH {LINES}, {BIGRAMS.format(src='toks')} SELECT w1, w2, count FROM bc")
def txt_bigram_counts(spark, sf):
    return X.bigram_counts(lines(spark, sf))


@query("txt_bigram_marginals", f"""
    WITH {LINES}, {BIGRAMS.format(src='toks')} SELECT w1, sum(count)::BIGINT AS total FROM bc GROUP BY w1
""")
def txt_bigram_marginals(spark, sf):
    return X.head_totals(X.bigram_counts(lines(spark, sf)))


RELFREQ = f"""
    WITH {LINES}, {BIGRAMS.format(src='toks')},
    rf AS (SELECT w1, w2, round(count / sum(count) OVER (PARTITION BY w1), 9) AS rel_freq, count FROM bc)
"""


@query("txt_bigram_relfreq_pairs", f"""
    {RELFREQ} SELECT * FROM rf ORDER BY rel_freq DESC, count DESC, w1, w2 LIMIT 50
""")
def txt_bigram_relfreq_pairs(spark, sf):
    rf = X.relative_frequencies(X.bigram_counts(lines(spark, sf)))
    return rf.withColumn("rel_freq", F.round("rel_freq", 9)).orderBy(
        F.desc("rel_freq"), F.desc("count"), "w1", "w2").limit(50)


@query("txt_bigram_relfreq_all", f"{RELFREQ} SELECT * FROM rf")
def txt_bigram_relfreq_all(spark, sf):
    rf = X.relative_frequencies(X.bigram_counts(lines(spark, sf)))
    return rf.withColumn("rel_freq", F.round("rel_freq", 9))


@query("txt_bigram_relfreq_stripes", f"""
    {RELFREQ} SELECT w1, w2, rel_freq FROM rf ORDER BY rel_freq DESC, w1, w2 LIMIT 50
""")
def txt_bigram_relfreq_stripes(spark, sf):
    rf = X.stripe_relative_frequencies(X.bigram_counts(lines(spark, sf)))
    return rf.select("w1", "w2", F.round("rel_freq", 9).alias("rel_freq")).orderBy(
        F.desc("rel_freq"), "w1", "w2").limit(50)


@query("agg_map_merge", f"""
    WITH {LINES}, {BIGRAMS.format(src='toks')},
    seg AS (SELECT w1, w2, count, ('0x' || substr(md5(w2), 1, 8))::BIGINT % 16 AS segment FROM bc)
    SELECT w1, segment, string_agg(w2 || ':' || count, ',' ORDER BY w2) AS stripe, count(*)::INTEGER AS entries
    FROM seg GROUP BY w1, segment
""")
def agg_map_merge(spark, sf):
    """Stripes of bigram followers, each head dealt over 16 segments."""
    striped = X.stripes(X.bigram_counts(lines(spark, sf)), "w1", "w2")
    text = F.transform(F.map_entries("stripe"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return striped.select("w1", "segment", F.array_join(text, ",").alias("stripe"), F.size("stripe").alias("entries"))


@query("txt_head_totals", f"""
    WITH {LINES}, {BIGRAMS.format(src='toks')}
    SELECT w1, sum(count)::BIGINT AS total FROM bc GROUP BY w1 ORDER BY total DESC, w1 LIMIT 20
""")
def txt_head_totals(spark, sf):
    return X.head_totals(X.bigram_counts(lines(spark, sf))).orderBy(F.desc("total"), "w1").limit(20)


BIGRAM_PMI = """
    WC AS (SELECT w, count(*) AS n FROM (SELECT unnest(t) AS w FROM {src}) GROUP BY w),
    tot AS (SELECT sum(greatest(len(t) - 1, 0))::DOUBLE AS total FROM {src}),
    pmi AS (SELECT w1, w2, round(log10(count::DOUBLE / a.n * total / b.n), 6) AS pmi, count
            FROM bc JOIN WC a ON w1 = a.w JOIN WC b ON w2 = b.w, tot WHERE count >= 10)
"""


@query("txt_bigram_pmi", f"""
    WITH {LINES}, {BIGRAMS.format(src='toks')}, {BIGRAM_PMI.format(src='toks')}
    SELECT * FROM pmi ORDER BY pmi DESC, count DESC, w1, w2 LIMIT 100
""")
def txt_bigram_pmi(spark, sf):
    return X.bigram_pmi(lines(spark, sf)).withColumn("pmi", F.round("pmi", 6)).orderBy(
        F.desc("pmi"), F.desc("count"), "w1", "w2").limit(100)


@query("txt_bigram_pmi_whole", f"""
    WITH {LINES}, {BIGRAMS.format(src='toks')}, {BIGRAM_PMI.format(src='toks')} SELECT * FROM pmi
""")
def txt_bigram_pmi_whole(spark, sf):
    """All frequent bigrams, not only the report's 100."""
    return X.bigram_pmi(lines(spark, sf)).withColumn("pmi", F.round("pmi", 6))


# --- co-occurrence ---------------------------------------------------------

PMI = """
    pmi AS (SELECT x, y, round(log10(count::DOUBLE / a.n * (SELECT count(*) FROM b) / c.n), 6) AS pmi, count
            FROM pc JOIN m a ON x = a.tok JOIN m c ON y = c.tok WHERE count >= 5)
"""


COOC = f"WITH {LINES}, {NEAR.format(src='toks')}, {BASKETS}"


@query("txt_cooc_pairs", f"{COOC} SELECT x, y, count FROM pc WHERE count >= 5")
def txt_cooc_pairs(spark, sf):
    return X.cooccurrence(X.baskets(lines(spark, sf)), X.PAIR_THRESHOLD).select("x", "y", "count")


@query("txt_pmi_pairs", f"{COOC}, {PMI} SELECT * FROM pmi")
def txt_pmi_pairs(spark, sf):
    return X.pmi_pairs(lines(spark, sf)).withColumn("pmi", F.round("pmi", 6))


@query("txt_pmi_stripes", f"{COOC}, {PMI} SELECT x, y, pmi, count FROM pmi UNION ALL SELECT y, x, pmi, count FROM pmi")
def txt_pmi_stripes(spark, sf):
    return X.pmi_stripes(lines(spark, sf)).withColumn("pmi", F.round("pmi", 6))


@query("jn_lookup_scalar", f"""
    WITH {LINES}, wc AS (SELECT w, count(*) AS n FROM (SELECT unnest(t) AS w FROM toks) GROUP BY w),
    {BIGRAMS.format(src='toks')}
    SELECT w1, w2, count, a.n AS n1, b.n AS n2 FROM bc JOIN wc a ON w1 = a.w JOIN wc b ON w2 = b.w
    WHERE count >= 5
""")
def jn_lookup_scalar(spark, sf):
    """Marginal counts looked up for both words of every frequent bigram."""
    ls = lines(spark, sf)
    return X.with_word_counts(X.bigram_counts(ls).filter("count >= 5"), X.word_count(ls))


POSITIONAL = f"""
    WITH {LINES}, whole AS (SELECT doc_id, line_no, t FROM toks WHERE len(t) > 1), {NEAR.format(src='whole')},
    m AS (SELECT tok, count(*) AS n FROM bt GROUP BY tok),
    pc AS (SELECT a AS x, b AS y, count(*) AS count FROM near GROUP BY ALL HAVING count(*) >= 5),
    pmi AS (SELECT x, y, round(log10(count::DOUBLE / a.n * (SELECT count(*) FROM whole) / c.n), 6) AS pmi, count
            FROM pc JOIN m a ON x = a.tok JOIN m c ON y = c.tok)
"""


@query("doc_pmi_positional", f"{POSITIONAL} SELECT * FROM pmi")
def doc_pmi_positional(spark, sf):
    return X.positional_pmi(lines(spark, sf)).withColumn("pmi", F.round("pmi", 6))


@query("doc_pmi_positional_stripes", f"""
    {POSITIONAL} SELECT x, ('0x' || substr(md5(y), 1, 8))::BIGINT % 16 AS segment,
      string_agg(y || ':' || printf('%.6f', pmi) || ':' || count, ' ' ORDER BY y) AS stripe FROM pmi GROUP BY ALL
""")
def doc_pmi_positional_stripes(spark, sf):
    striped = X.positional_stripes(X.positional_pmi(lines(spark, sf)).withColumn("pmi", F.round("pmi", 6)))
    text = F.transform(F.map_entries("stripe"), lambda e: F.concat_ws(
        ":", e["key"], F.format_string("%.6f", e["value"]["pmi"]), e["value"]["count"].cast("string")))
    return striped.select("x", "segment", F.array_join(text, " ").alias("stripe"))


@query("txt_hash_ngrams", """
    WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM documents),
    g AS (SELECT doc_id, unnest(t) AS gram FROM t UNION ALL
          SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || '_' || t[i+1])) FROM t WHERE len(t) > 1)
    SELECT doc_id, (('0x' || substr(md5(gram), 28, 5))::BIGINT % 262144)::INTEGER AS idx, count(*) AS n
    FROM g GROUP BY ALL
""")
def txt_hash_ngrams(spark, sf):
    return X.hashed_ngrams(table(spark, sf, "documents"), "doc_id", "text")
