"""Word, bigram and co-occurrence statistics over a ``line`` column.

Counts are always taken in long form (one row per key) with map-side partial
aggregation, so a word that makes up much of the corpus costs one row per map
task in the shuffle. Nested "stripes" are built from the counts afterwards, in
segments of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.functions import tokens as T
from marlspike.functions.hashing import HASH_DIM, md5_bucket, slot
from marlspike.operators import near
from marlspike.operators.spread import gathered, small_parts
from marlspike.session import cut_lineage

#: Two words of a line are a pair if at most DISTANCE - 1 tokens apart, so that output stays linear in the text.
DISTANCE = 40
# The count thresholds of the PMI reports.
PAIR_THRESHOLD = 5
BIGRAM_THRESHOLD = 10

#: Segments that every stripe is dealt over, by the hash of the item.
STRIPE_SEGMENTS = 16
#: Followers of a head whose stripe is kept whole.
MOST_FOLLOWERS = 1 << 15

#: Rows of an id whose texts are brought together, and partitions of texts for every split of the scan.
MOST_TEXTS = 1000
GRAM_PARTS = 32


def words(lines: DataFrame) -> DataFrame:
    return T.each(lines, [], T.letters(F.col("line")), "token")


def word_count(lines: DataFrame) -> DataFrame:
    return words(lines).groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def top_words(lines: DataFrame, k: int = 10) -> DataFrame:
    return word_count(lines).orderBy(F.desc("count"), "token").limit(k)


def bigrams(lines: DataFrame) -> DataFrame:
    """One row per pair of neighbouring tokens within a line."""
    toks = lines.select(T.letters(F.col("line")).alias("t"))
    return T.each(toks, [], T.adjacent(F.col("t")), "b").select("b.w1", "b.w2")


def bigram_counts(lines: DataFrame) -> DataFrame:
    return bigrams(lines).groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("count"))


def followers(lines: DataFrame, head: str, min_count: int = 2) -> DataFrame:
    """Tokens right after ``head`` in a line, with their counts."""
    return (
        bigrams(lines.filter(F.lower("line").contains(head)))
        .filter(F.col("w1") == head)
        .groupBy(F.col("w2").alias("follower"))
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") >= min_count)
        .orderBy(F.desc("count"), "follower")
    )


def head_totals(counts: DataFrame) -> DataFrame:
    """Occurrences of each token as the first of a bigram."""
    return counts.groupBy("w1").agg(F.sum("count").alias("total"))


def relative_frequencies(counts: DataFrame) -> DataFrame:
    """count / head total by an aggregate and a join.

    A window over ``w1`` would pull all followers of a frequent head into one task. The
    totals are materialised: only a join of two plain shuffles can be split at such a head.
    """
    return counts.join(cut_lineage(head_totals(counts)), "w1").select(
        "w1", "w2", (F.col("count") / F.col("total")).alias("rel_freq"), "count"
    )


def stripes(counts: DataFrame, key: str, item: str, segments: int | Column = STRIPE_SEGMENTS, value: str = "count") -> DataFrame:
    """``key -> {item: value}``; a key is dealt over its number of segments by the hash of the item.

    Plain rows are shuffled: lists of a task's few items of a key take more room than these.
    """
    n = segments if isinstance(segments, Column) else F.lit(segments)
    segment = F.when(n > 1, slot(F.col(item), n)).otherwise(F.lit(0).cast("bigint"))
    return (
        counts.select(key, item, value, segment.alias("segment"))
        .repartition(key, "segment")
        .groupBy(key, "segment")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(item, value)))).alias("stripe"))
    )


def stripe_relative_frequencies(counts: DataFrame, segments: int = STRIPE_SEGMENTS) -> DataFrame:
    """Relative frequencies by dividing each stripe's entries by the stripe's total.

    Stripes are whole and hold their total. Only heads with more than ``MOST_FOLLOWERS``
    followers, at most one in so many rows, are dealt over segments that share a total.
    """
    counts = cut_lineage(counts)
    large = F.broadcast(cut_lineage(
        counts.groupBy("w1").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("followers"))
        .filter(F.col("followers") > MOST_FOLLOWERS).select("w1", "total")))
    dealt = F.when(F.col("total").isNull(), 1).otherwise(segments)
    own = F.aggregate(F.map_values("stripe"), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return (
        stripes(counts.join(large, "w1", "left"), "w1", "w2", dealt).join(large, "w1", "left")
        # added up before the stripe is taken apart, not once an entry
        .select("w1", F.coalesce("total", own).alias("total"), "stripe")
        .select("w1", "total", F.explode("stripe").alias("w2", "count"))
        .select("w1", "w2", (F.col("count") / F.col("total")).alias("rel_freq"), "count")
    )


# --- co-occurrence within a line -------------------------------------------

LINE_KEYS = ("doc_id", "line_no")


def baskets(lines: DataFrame, keys: Sequence[str] = LINE_KEYS) -> DataFrame:
    """``*keys, t``: all tokens of each line, in order; null for lines with fewer than two different ones.

    A filter on the size would be pushed below the tokenising and repeat it, so
    small lines are made null here and vanish when exploded.
    """
    toks = lines.select(*keys, T.letters(F.col("line")).alias("t"))
    return toks.withColumn("t", F.when(F.size(F.array_distinct("t")) > 1, F.col("t")))


def basket_marginals(basket: DataFrame) -> DataFrame:
    """``token, n``: lines per token; the empty token stands for all lines."""
    return (
        T.each(basket, [], F.array_append(F.array_distinct("t"), F.lit("")), "token")
        .groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    )


def _coded(marginals: DataFrame) -> tuple[DataFrame, int]:
    """The words with their hashes ``id``, and the seed under which these differ."""
    words = marginals.filter(F.col("token") != "")
    seed = near.distinct_seed(words)
    return words.withColumn("id", near.word_hash(F.col("token"), seed)), seed


def cooccurrence(basket: DataFrame, threshold: int, distance: int = DISTANCE, chunk: int = near.STEP) -> DataFrame:
    """Unordered pairs ``x < y`` near each other in at least ``threshold`` lines: ``x, y, count, n_x, n_y, baskets``.

    A line counts once for a pair, however often its words meet within ``distance``.
    Pairs are counted on word hashes inside the lines (``operators/near.py``), so no token
    is shuffled, and only pairs that reach the threshold get their words.
    """
    marginals = cut_lineage(basket_marginals(basket))
    total = marginals.filter("token = ''").select("n").scalar()
    coded, seed = _coded(marginals)
    ids = basket.select(F.transform("t", lambda w: near.word_hash(w, seed)).alias("ids"))
    found = near.pair_counts(ids, coded, threshold, distance, ordered=False, step=chunk)
    low, high = F.least("a", "b"), F.greatest("a", "b")
    return found.select(low["token"].alias("x"), high["token"].alias("y"), "count", low["n"].alias("n_x"), high["n"].alias("n_y"),
                        total.alias("baskets"))


def pmi(count: Column, n_x: Column, n_y: Column, total: Column) -> Column:
    """log10(count · total / (n_x · n_y)), divided stepwise so no product of large counts arises."""
    return F.log10(count.cast("double") / n_x * total / n_y)


def _pair_pmi() -> Column:
    return pmi(F.col("count"), F.col("n_x"), F.col("n_y"), F.col("baskets"))


def pmi_pairs(lines: DataFrame, threshold: int = PAIR_THRESHOLD, distance: int = DISTANCE) -> DataFrame:
    pairs = cooccurrence(baskets(lines), threshold, distance=distance)
    return pairs.select("x", "y", _pair_pmi().alias("pmi"), "count")


def pmi_stripes(lines: DataFrame, threshold: int = PAIR_THRESHOLD, distance: int = DISTANCE,
                segments: int = STRIPE_SEGMENTS) -> DataFrame:
    """The same values through stripes ``x -> {y: count}``, which list every pair in both directions."""
    pairs = cut_lineage(cooccurrence(baskets(lines), threshold, distance=distance))
    flip = F.array(F.struct("x", "y", "n_x"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), F.col("n_y").alias("n_x")))
    both = pairs.select(F.explode(flip).alias("p"), "count", "baskets").select("p.*", "count", "baskets")
    tokens = cut_lineage(both.groupBy("x").agg(F.max("n_x").alias("n"), F.max("baskets").alias("baskets")))
    striped = stripes(both.select("x", "y", "count"), "x", "y", segments).join(
        tokens.withColumnRenamed("n", "n_x"), "x")
    return (
        striped.select("x", "n_x", "baskets", F.explode("stripe").alias("y", "count"))
        .join(tokens.select(F.col("x").alias("y"), F.col("n").alias("n_y")), "y")
        .select("x", "y", _pair_pmi().alias("pmi"), "count")
    )


def with_word_counts(counts: DataFrame, words: DataFrame) -> DataFrame:
    """``w1, w2, count, n1, n2``: bigrams with the counts of both words, from ``words`` (token, count).

    All tables are materialised, so that the joins can be split at a very common word.
    """
    counts, words = cut_lineage(counts), cut_lineage(words)
    first = words.select(F.col("token").alias("w1"), F.col("count").alias("n1"))
    second = words.select(F.col("token").alias("w2"), F.col("count").alias("n2"))
    return counts.join(first, "w1").join(second, "w2").select("w1", "w2", "count", "n1", "n2")


def with_pmi(pairs: DataFrame, x: str, y: str, marginals: DataFrame, total: Column) -> DataFrame:
    """PMI by two look-ups of the marginal counts ``token, n``."""
    first = marginals.select(F.col("token").alias(x), F.col("n").alias("_nx"))
    second = marginals.select(F.col("token").alias(y), F.col("n").alias("_ny"))
    value = pmi(F.col("count"), F.col("_nx"), F.col("_ny"), total)
    return pairs.join(first, x).join(second, y).select(x, y, value.alias("pmi"), "count")


def bigram_pmi(lines: DataFrame, threshold: int = BIGRAM_THRESHOLD) -> DataFrame:
    """PMI of neighbouring tokens; probabilities are over the number of bigrams.

    One pass over the lines: every token is counted as a bigram with an empty end where it
    has no successor, so words and the number of bigrams are sums over the same counts.
    """
    toks = lines.select(T.letters(F.col("line")).alias("t"))
    pair = F.transform("t", lambda w, i: F.struct(w.alias("w1"), F.coalesce(F.get("t", i + 1), F.lit("")).alias("w2")))
    counts = cut_lineage(
        T.each(toks, [], pair, "b").groupBy("b.w1", "b.w2").agg(F.count(F.lit(1)).alias("count")))
    marginals = cut_lineage(counts.groupBy(F.col("w1").alias("token")).agg(F.sum("count").alias("n")))
    pairs = counts.filter("w2 <> ''")
    total = pairs.agg(F.sum("count")).scalar()
    return with_pmi(pairs.filter(F.col("count") >= threshold), "w1", "w2", marginals, total)


def total_bigrams(lines: DataFrame) -> DataFrame:
    n = F.size(T.letters(F.col("line")))
    return lines.agg(F.sum(F.greatest(n - 1, F.lit(0))).alias("total"))


def positional_pmi(lines: DataFrame, threshold: int = PAIR_THRESHOLD, distance: int = DISTANCE, chunk: int = near.STEP) -> DataFrame:
    """PMI over raw ordered token pairs (earlier, later) of a line within ``distance``, repeats included."""
    toks = lines.select(T.letters(F.col("line")).alias("t"))
    toks = toks.withColumn("t", F.when(F.size("t") > 1, F.col("t")))
    # the empty token stands for lines
    marginals = cut_lineage(
        T.each(toks, [], F.array_append("t", F.lit("")), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    total = marginals.filter("token = ''").select("n").scalar()
    coded, seed = _coded(marginals)
    ids = toks.select(F.transform("t", lambda w: near.word_hash(w, seed)).alias("ids"))
    pairs = near.pair_counts(ids, coded, threshold, distance, ordered=True, step=chunk)
    value = pmi(F.col("count"), F.col("a.n"), F.col("b.n"), total)
    return pairs.select(F.col("a.token").alias("x"), F.col("b.token").alias("y"), value.alias("pmi"), "count")


def positional_stripes(pairs: DataFrame, segments: int = STRIPE_SEGMENTS) -> DataFrame:
    """``x -> {y: (pmi, count)}`` of scored pairs."""
    return stripes(pairs.select("x", "y", F.struct("pmi", "count").alias("score")), "x", "y", segments, "score")


def hashed_ngrams(docs: DataFrame, id_col: str, text_col: str, dim: int = HASH_DIM, gather: bool = True) -> DataFrame:
    """``(id, idx, n)``: counts of hashed unigrams and ``a_b`` bigrams of each document.

    Texts are brought together by id, so that no gram is shuffled. Ids with more than
    ``MOST_TEXTS`` rows are rare; their grams are added up in the tasks that read them.
    Without ``gather`` all grams are, and the rows are dealt by id and bucket.
    """
    docs = docs.select(id_col, text_col)
    if not gather:
        return _hashed(docs, id_col, text_col, dim).groupBy(id_col, "idx").agg(F.count(F.lit(1)).alias("n"))
    often = cut_lineage(docs.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MOST_TEXTS))
    keys = [id_col, "idx"]
    if often.isEmpty():
        return _hashed(gathered(docs, id_col, per_split=GRAM_PARTS), id_col, text_col, dim).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    rare, hot = (docs.join(often, same, how) for how in ("left_anti", "left_semi"))
    counted = [_hashed(d, id_col, text_col, dim).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
               for d in (rare.repartition(small_parts(docs, GRAM_PARTS), id_col), hot)]
    return counted[0].unionByName(counted[1])


def _hashed(docs: DataFrame, id_col: str, text_col: str, dim: int) -> DataFrame:
    """``(id, idx)``, a row per gram; one array holds the bigrams and, without a second word, the unigrams."""
    toks = docs.select(id_col, T.alphanumerics(F.col(text_col)).alias("t"))
    m = F.greatest(F.size("t") - 1, F.lit(0))
    grams = F.arrays_zip(F.concat(F.slice("t", F.lit(1), m), F.col("t")).alias("a"), F.slice("t", F.lit(2), m).alias("b"))
    return T.each(toks, [id_col], grams, "p").select(id_col, md5_bucket(F.concat_ws("_", "p.a", "p.b"), dim).alias("idx"))
