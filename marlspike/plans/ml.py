"""Registered model and metric queries.

Text models use labelled documents; market models use the feature table of the
hourly bars. Metrics that SQL can express have oracles; fitted models do not.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marlspike.functions.hashing import slot
from marlspike.operators import metrics as K
from marlspike.operators import ml as M
from marlspike.operators import series as S
from marlspike.operators.spread import spread
from marlspike.operators.text import hashed_ngrams
from marlspike.plans.registry import query
from marlspike.plans.series import feature_table
from marlspike.session import cut_lineage
from marlspike.sources.tables import table

LABEL = "target_direction"

SCORED = """
    s AS (SELECT (o_orderstatus = 'F')::INTEGER AS label, o_totalprice / 500000 AS score FROM orders)
"""


def _scored(spark, sf):
    return table(spark, sf, "orders").select(
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        (F.col("o_totalprice") / 500000).alias("score"))


# --- splits, scaling, metrics ----------------------------------------------

@query("ml_random_split", """
    SELECT doc_id, CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 100 < 80
                        THEN 'train' ELSE 'test' END AS split FROM documents
""")
def ml_random_split(spark, sf):
    return M.hash_split(table(spark, sf, "documents").select("doc_id"), "doc_id")


Z = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


Z_SQL = f"""
    SELECT l_orderkey, l_linenumber, l_partkey, {", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) + 0.0::DOUBLE AS z_{c}" for c in Z)}
    FROM lineitem
"""


@query("ml_assemble_scale", Z_SQL)
def ml_assemble_scale(spark, sf):
    keep = ["l_orderkey", "l_linenumber", "l_partkey"]
    z = M.standardise(table(spark, sf, "lineitem").select(*keep, *Z), Z, keep)
    return z.select(*keep, *[(F.round(f"z_{c}", 6) + F.lit(0.0)).alias(f"z_{c}") for c in Z])


@query("ml_threshold_metrics", f"""
    WITH {SCORED}, c AS (SELECT count(*) FILTER (label = 1 AND score >= 0.5) AS tp,
      count(*) FILTER (label = 0 AND score >= 0.5) AS fp, count(*) FILTER (label = 1 AND score < 0.5) AS fn,
      count(*) FILTER (label = 0 AND score < 0.5) AS tn FROM s)
    SELECT tp, fp, fn, tn, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision,
           round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall FROM c
""")
def ml_threshold_metrics(spark, sf):
    return K.threshold_counts(_scored(spark, sf), "label", "score").select(
        "tp", "fp", "fn", "tn", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


AUC = """
    r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM s),
    a AS (SELECT sum(rk) FILTER (label = 1) AS rs, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM r)
"""


@query("ml_auc_ranksum", f"""
    WITH {SCORED}, {AUC}
    SELECT p AS positives, n AS negatives, round((rs - p::DOUBLE * (p + 1) / 2) / (p::DOUBLE * n), 9) AS auc FROM a
""")
def ml_auc_ranksum(spark, sf):
    return K.auc(_scored(spark, sf), "label", "score").withColumn("auc", F.round("auc", 9))


@query("ml_auc_ties", """
    WITH s AS (SELECT (l_returnflag = 'R')::INTEGER AS label, l_discount * 100 + l_tax AS score FROM lineitem),
    r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM s),
    a AS (SELECT sum(rk) FILTER (label = 1) AS rs, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM r)
    SELECT p AS positives, n AS negatives, round((rs - p::DOUBLE * (p + 1) / 2) / (p::DOUBLE * n), 9) AS auc FROM a
""")
def ml_auc_ties(spark, sf):
    """Few distinct scores, each shared by many rows."""
    scored = table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_discount") * 100 + F.col("l_tax")).alias("score"))
    return K.auc(scored, "label", "score").withColumn("auc", F.round("auc", 9))


@query("ml_eval", f"""
    WITH {SCORED}, {AUC}, z AS (SELECT label, (score >= 0.5)::INTEGER AS z FROM s),
    k AS (SELECT c, (SELECT count(*) FROM z WHERE label = c) AS actual, (SELECT count(*) FROM z WHERE z = c) AS predicted,
            (SELECT count(*) FROM z WHERE label = c AND z = c) AS hit FROM (VALUES (0), (1)) v(c)),
    m AS (SELECT actual, hit, coalesce(hit / nullif(predicted, 0), 0) AS pr, coalesce(hit / nullif(actual, 0), 0) AS re FROM k)
    SELECT round(sum(hit) / sum(actual), 9) AS accuracy, round(sum(pr * actual) / sum(actual), 9) AS weighted_precision,
      round(sum(re * actual) / sum(actual), 9) AS weighted_recall,
      round(sum(coalesce(2 * pr * re / nullif(pr + re, 0), 0) * actual) / sum(actual), 9) AS f1,
      (SELECT round((rs - p::DOUBLE * (p + 1) / 2) / (p::DOUBLE * n), 9) FROM a) AS auc FROM m
""")
def ml_eval(spark, sf):
    scored = _scored(spark, sf).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    auc = K.auc(scored, "label", "score").select("auc").scalar()
    cells = K.classification(scored, "label", "prediction")
    return cells.select(*[F.round(c, 9).alias(c) for c in cells.columns], F.round(auc, 9).alias("auc"))


@query("ml_majority_baseline", """
    SELECT l_returnflag AS label, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem), 6) AS share
    FROM lineitem GROUP BY 1 ORDER BY n DESC, label LIMIT 1
""")
def ml_majority_baseline(spark, sf):
    return K.majority(table(spark, sf, "lineitem"), "l_returnflag")


# --- text models -----------------------------------------------------------

def _labelled_grams(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    docs = table(spark, sf, "documents").select("doc_id", "text").join(labels.select("doc_id"), "doc_id", "left_semi")
    # a fit depends on how its rows are dealt, so they stay dealt as they were
    return hashed_ngrams(spread(docs), "doc_id", "text", gather=False), labels


@query("ml_logreg")
def ml_logreg(spark, sf):
    """Hashed n-gram regression on the toxic label: AUC and threshold metrics on the held-out part."""
    grams, labels = _labelled_grams(spark, sf)
    rows = labels.join(M.sparse_vectors(grams, "doc_id"), "doc_id")
    rows = cut_lineage(M.hash_split(rows, "doc_id"))
    model = M.text_model(rows.filter("split = 'train'"))
    scored = model.transform(rows.filter("split = 'test'")).select(
        "label", vector_to_array("probability")[1].alias("score"))
    auc = K.auc(scored, "label", "score").select("auc").scalar()
    return K.threshold_counts(scored, "label", "score").withColumn("auc", auc)


EPOCHS = 5

SGD = f"""
    WITH RECURSIVE l AS (SELECT doc_id, toxic::DOUBLE AS y FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)),
    t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM documents JOIN l USING (doc_id)),
    gr AS (SELECT doc_id, unnest(t) AS gram FROM t UNION ALL
      SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || '_' || t[i+1])) FROM t WHERE len(t) > 1),
    every AS MATERIALIZED (SELECT doc_id, idx, n, y, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 5 = 0 AS held_out FROM (
      SELECT doc_id, (('0x' || substr(md5(gram), 28, 5))::BIGINT % 262144)::INTEGER AS idx, count(*) AS n FROM gr GROUP BY ALL
      UNION ALL SELECT doc_id, -1, 1 FROM l) JOIN l USING (doc_id)),
    dealt AS (SELECT doc_id, (row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id, y) - 1) // {M.BATCH_DOCS} AS batch
              FROM l WHERE ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 5 <> 0),
    f AS MATERIALIZED (SELECT every.*, batch, count(*) FILTER (idx = -1) OVER (PARTITION BY batch) AS size FROM every JOIN dealt USING (doc_id)),
    nb AS MATERIALIZED (SELECT max(batch) + 1 AS nb FROM dealt),
    w AS (
      SELECT 0::BIGINT AS step, idx, 0.0::DOUBLE AS w FROM (SELECT DISTINCT idx FROM f)
      UNION ALL
      SELECT w.step + 1, w.idx, coalesce(w.w - 0.1 * 0.9 ** (w.step // nb) * (g / size + 1e-5 * w.w), w.w)
      FROM w CROSS JOIN nb LEFT JOIN (
        SELECT idx, sum(e * n) AS g, any_value(size) AS size FROM f JOIN (
          SELECT doc_id, 1 / (1 + exp(-greatest(least(sum(n * w), 30), -30))) - max(y) AS e
          FROM f JOIN w USING (idx) CROSS JOIN nb WHERE batch = step % nb GROUP BY doc_id) USING (doc_id) GROUP BY idx) g USING (idx)
      WHERE step < {EPOCHS} * nb),
    last AS MATERIALIZED (SELECT idx, w FROM w CROSS JOIN nb WHERE step = {EPOCHS} * nb),
    p AS (SELECT doc_id, max(y) AS y, 1 / (1 + exp(-greatest(least(sum(n * coalesce(w, 0)), 30), -30))) AS probability
          FROM every LEFT JOIN last USING (idx) WHERE held_out GROUP BY doc_id)
"""


def _sgd_held_out(spark, sf):
    """Five epochs of gradient steps over batches of the training part; probabilities of the held-out fifth."""
    grams, labels = _labelled_grams(spark, sf)
    grams = cut_lineage(grams)
    known = labels.join(table(spark, sf, "documents").select("doc_id"), "doc_id", "left_semi")
    held_out = slot(F.col("doc_id").cast("string"), F.lit(5)) == 0
    weights = M.sgd_weights(grams, known.filter(~held_out), "doc_id", epochs=EPOCHS)
    scores = M.sgd_scores(grams, weights, known.filter(held_out), "doc_id")
    return known.filter(held_out).join(scores, "doc_id")


@query("ml_sgd_logreg", f"{SGD} SELECT doc_id, round(probability, 9) AS probability FROM p")
def ml_sgd_logreg(spark, sf):
    return _sgd_held_out(spark, sf).select("doc_id", F.round("probability", 9).alias("probability"))


@query("ml_sgd_metrics", f"""
    {SGD}, s AS (SELECT y AS label, round(probability, 9) AS score FROM p), {AUC}
    SELECT count(*) AS n, sum(label)::BIGINT AS positives, count(*) FILTER (score >= 0.5 AND label = 1) AS true_positives,
      count(*) FILTER (score >= 0.5 AND label = 0) AS false_positives, round(avg(score), 6) AS mean_probability,
      (SELECT round((rs - p::DOUBLE * (p + 1) / 2) / (p::DOUBLE * n), 9) FROM a) AS auc FROM s
""")
def ml_sgd_metrics(spark, sf):
    """Counts of the held-out part at threshold 0.5, and the area under its ROC curve."""
    scored = cut_lineage(_sgd_held_out(spark, sf).withColumn("probability", F.round("probability", 9)))
    high = F.col("probability") >= 0.5
    auc = K.auc(scored, "label", "probability").select(F.round("auc", 9)).scalar()
    return scored.agg(
        F.count("*").alias("n"), F.sum("label").cast("long").alias("positives"),
        F.count(F.when(high & (F.col("label") == 1), 1)).alias("true_positives"),
        F.count(F.when(high & (F.col("label") == 0), 1)).alias("false_positives"),
        F.round(F.avg("probability"), 6).alias("mean_probability")).withColumn("auc", auc)


# --- market models ---------------------------------------------------------

def _market(spark, sf):
    """Train and test parts of the feature table, split by time; read many times by the fits."""
    full = cut_lineage(S.chronological_split(feature_table(spark, sf)))
    return full.filter("split = 'train'"), full.filter("split = 'test'"), M.feature_columns(full)


def _fitted(spark, sf, kind, run_id, columns=None, **settings):
    train, test, every = _market(spark, sf)
    model = M.fit(train, kind, columns or every, LABEL, **settings)
    found = {stage: M.evaluate(model.transform(part), LABEL) for stage, part in (("train", train), ("test", test))}
    return M.metric_rows(spark, run_id, "train", found["train"]).unionByName(M.metric_rows(spark, run_id, "test", found["test"]))


@query("ml_logreg_baseline")
def ml_logreg_baseline(spark, sf):
    return _fitted(spark, sf, "logreg", "baseline", list(M.BASIC))


@query("ml_logreg_advanced")
def ml_logreg_advanced(spark, sf):
    return _fitted(spark, sf, "logreg", "lr_advanced")


@query("ml_random_forest")
def ml_random_forest(spark, sf):
    return _fitted(spark, sf, "forest", "rf_advanced")


@query("ml_gbt")
def ml_gbt(spark, sf):
    return _fitted(spark, sf, "boosting", "gbt_advanced")


@query("ml_importance")
def ml_importance(spark, sf):
    train, _, every = _market(spark, sf)
    return M.importances(M.fit(train, "forest", every, LABEL), every, spark)


@query("ml_tune")
def ml_tune(spark, sf):
    """Validation AUC of every point of the forest grid, and the test metrics of the best one's model."""
    train, test, every = _market(spark, sf)
    model, scores = M.tune_forest(train, every, LABEL)
    found = M.evaluate(model.transform(test), LABEL)
    best = model.stages[-1]
    chosen = (F.col("numTrees") == best.getNumTrees) & (F.col("maxDepth") == best.getMaxDepth()) & (
        F.col("minInstancesPerNode") == best.getMinInstancesPerNode())
    return scores.withColumns({f"test_{m}": F.when(chosen, F.lit(found[m])) for m in ("auc", "accuracy", "f1")})


@query("ml_ablation")
def ml_ablation(spark, sf):
    train, test, every = _market(spark, sf)
    return M.ablation(train, test, every, LABEL)
