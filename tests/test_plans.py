"""Physical plans: what reaches the scan, and what must not appear."""

import pytest

import __spark_entry__ as entry
from marlspike.operators import graph as G
from marlspike.operators import index as I
from marlspike.operators import text as X
from marlspike.plans import retrieval
from marlspike.session import cut_lineage
from marlspike.sources.tables import table

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_filter_and_columns_reach_the_scan(spark):
    p = plan(QUERIES["q1_shipped_count"](spark, SF))
    assert "EqualTo(l_shipdate" in p and "ReadSchema: struct<l_shipdate:timestamp_ntz>" in p


def test_nation_filter_reaches_the_scan(spark):
    assert "In(n_name" in plan(QUERIES["q5_monthly_volumes"](spark, SF))


@pytest.mark.parametrize("name", [
    "q2_clerks_semi", "q5_monthly_volumes", "q7_shipping_priority", "txt_wordcount_topk", "txt_bigram_relfreq_pairs",
    "txt_hash_ngrams", "idx_build", "ret_rank_top10", "st_trending_window", "agg_multi", "blk_header"])
def test_no_python_and_no_pair_products(spark, name):
    p = plan(QUERIES[name](spark, SF))
    for bad in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert bad not in p


@pytest.mark.parametrize("name", ["win_moving_avg", "ts_bollinger", "st_trending_alert"])
def test_windows_have_a_partition(spark, name):
    """Only the one-row-per-part offset table may be gathered into one partition."""
    p = plan(QUERIES[name](spark, SF))
    assert p.count("Exchange SinglePartition") <= 1


def test_word_count_tokenises_once_per_line(spark):
    assert plan(QUERIES["txt_wordcount_topk"](spark, SF)).count("[^a-z]+") == 1


def test_part_limit_is_top_k(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["q3_part_supplier"](spark, SF))


def test_pagerank_edges_stay_in_place(spark):
    """A round joins the kept edges without an exchange above them."""
    edges = spark.range(200).selectExpr("id % 20 AS src", "id % 7 AS dst")
    e = cut_lineage(G.distinct_edges(edges))
    state = cut_lineage(G.out_degrees(e).selectExpr("node", "out_degree", "1 AS slots", "1.0D AS mass"))
    links = e.selectExpr("src", "dst", "int(pmod(hash(dst), 1)) AS slot").repartition(4, "src", "slot").sortWithinPartitions(
        "src", "slot").persist()
    links.count()
    p = plan(G._step(links, state, [1], 0.85)).split("InMemoryTableScan")[0]
    above = p[p.index("SortMergeJoin"):]
    assert "Exchange" not in above and "Sort [" not in above
    links.unpersist()


def test_top_k_ranks_prune_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["ret_rank_top10"](spark, SF))


@pytest.mark.parametrize("name", ["ret_and", "ret_or", "ret_top10_blocks", "doc_df_normalised_score"])
def test_retrieval_reads_the_stored_index_once(spark, name):
    scans = [line for line in plan(QUERIES[name](spark, SF)).splitlines() if "FileScan" in line]
    assert sum("postings#" in s for s in scans) == 1 and not any("text#" in s for s in scans)
    for s in scans:
        assert "bucket#" in s[s.index("PartitionFilters"):s.index("PushedFilters")] and "In(term" in s[s.index("PushedFilters"):]


def test_report_scores_once(spark):
    """Both operators and the totals come from one pass over the postings."""
    index = retrieval.stored_index(spark, SF)
    p = plan(I.block_report(index, retrieval.SEARCHES, 10))
    assert p.count("FileScan") == 1 and p.count("Exchange hashpartitioning") == 1


@pytest.fixture
def small_thresholds(spark):
    """No broadcasts, and partitions of a few kilobytes count as skewed."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_joins_are_split_at_a_hot_key(spark, small_thresholds):
    """Nine tenths of the rows have one key: its partition is read by several tasks."""
    edges = spark.range(40000).selectExpr("IF(id % 10 = 0, id, 7L) AS src", "id * 4096 AS dst")
    counts = spark.range(40000).selectExpr("IF(id % 10 = 0, concat('a', id), 'the') AS w1", "concat('b', id) AS w2", "5L AS count")
    words = spark.range(40000).selectExpr("explode(array(concat('a', id), concat('b', id))) AS token", "5L AS count").union(
        spark.createDataFrame([("the", 36000)], "token string, count long"))
    for df in (G.adjacency(edges), X.with_word_counts(counts, words)):
        df.write.format("noop").mode("overwrite").save()
        run = df.select("*")
        run.collect()
        assert "skew=true" in plan(run)


def test_tables_are_known(spark):
    with pytest.raises(KeyError):
        table(spark, SF, "nothing")
