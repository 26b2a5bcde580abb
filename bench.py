"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

``src_postings`` includes building the stored index, which the ``ret_`` queries after it read.
``head_totals_pN`` is the bigram aggregation (group by head, top 20) with N
shuffle partitions, over a prepared bigram table as in the published study.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from marlspike.operators import text as X  # noqa: E402
from marlspike.plans import QUERIES  # noqa: E402
from marlspike.plans.text import lines  # noqa: E402
from marlspike.session import build_session, cut_lineage  # noqa: E402

HEADLINES = [
    "q1_shipped_count", "q2_clerks_semi", "q2_clerks_inner", "q3_part_supplier", "q4_nation_shipments",
    "q5_monthly_volumes", "q6_pricing_summary", "q7_shipping_priority", "jn_mixed", "agg_multi",
    "txt_wordcount_topk", "txt_followers", "txt_head_totals", "txt_bigram_relfreq_pairs", "txt_bigram_pmi",
    "txt_cooc_pairs", "txt_pmi_pairs", "txt_hash_ngrams", "idx_build", "src_postings", "ret_rank_top10", "ret_top10_blocks",
    "win_moving_avg", "ts_all_features", "doc_ema_rsi_macd", "st_trending_alert", "st_hourly_count_stream",
    "gr_ppr", "ml_auc_ranksum", "ml_sgd_logreg", "ml_logreg_baseline",
]
SWEEP = (8, 50, 200)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    start = time.perf_counter()
    consume(fn())
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench")
    spark.sparkContext.setLogLevel("ERROR")
    for warm in ("q5_monthly_volumes", "txt_wordcount_topk"):
        consume(QUERIES[warm](spark, sf_dir))
    seconds = {name: timed(lambda n=name: QUERIES[n](spark, sf_dir)) for name in HEADLINES}

    counts = cut_lineage(X.bigram_counts(lines(spark, sf_dir)))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for n in SWEEP:
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        seconds[f"head_totals_p{n}"] = timed(
            lambda: X.head_totals(counts).orderBy(F.desc("total"), "w1").limit(20))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
