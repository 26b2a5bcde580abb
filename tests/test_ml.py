import math

import pytest
from pyspark.sql import functions as F

from marlspike.operators import metrics as K
from marlspike.operators import ml as M
from marlspike.operators.text import hashed_ngrams
from marlspike.sources.sinks import load_model, save_model

LABEL = "target_direction"


@pytest.fixture(scope="module")
def market(spark):
    """Rows whose direction follows one feature."""
    base = spark.range(400).select(
        F.col("id").alias("timestamp"), (F.rand(1) - 0.5).alias("return_1h"), F.rand(2).alias("ma_24h"),
        F.rand(3).alias("volume_ma6h"), F.rand(4).alias("tx_throughput"), F.rand(5).alias("bb_upper"))
    df = base.withColumn(LABEL, (F.col("return_1h") > 0).cast("int")).persist()
    return df.filter("timestamp < 320"), df.filter("timestamp >= 320"), M.feature_columns(df)


@pytest.mark.parametrize("kind,settings", [
    ("logreg", {}), ("forest", {"numTrees": 5, "maxDepth": 3}), ("boosting", {"maxIter": 3, "maxDepth": 2})])
def test_models_learn_and_save(market, kind, settings, tmp_path):
    train, test, columns = market
    assert LABEL not in columns and "timestamp" not in columns
    model = M.fit(train, kind, columns, LABEL, **settings)
    save_model(model, str(tmp_path / "model"))
    assert M.evaluate(load_model(str(tmp_path / "model")).transform(test), LABEL)["auc"] > 0.95
    if kind == "forest":
        assert M.importances(model, columns, train.sparkSession).first().feature == "return_1h"


def test_tuning(market):
    train, _, columns = market
    model, scores = M.tune_forest(train, columns, LABEL, {"numTrees": (2, 4), "maxDepth": (2,)})
    assert scores.count() == 2 and scores.filter("auc > 0.8").count() == 2
    assert "prediction" in model.transform(train).columns


def test_ablation(market):
    train, test, columns = market
    groups = M.ablation_groups(columns)
    assert groups["basic_technical"] == ["return_1h", "ma_24h", "bb_upper"]
    got = {r.feature_group: r.n_features for r in M.ablation(train, test, columns, LABEL, numTrees=2, maxDepth=2).collect()}
    assert got == {g: len(c) for g, c in groups.items()}


def test_metrics_agree_with_mllib(spark):
    df = spark.range(500).select(
        (F.rand(7) < 0.4).cast("double").alias(LABEL), F.round(F.rand(8), 1).alias("score")).withColumn(
        "prediction", (F.col("score") >= 0.5).cast("double")).withColumn("rawPrediction", F.col("score")).persist()
    want = M.evaluate(df, LABEL)
    got = K.classification(df, LABEL, "prediction").first()
    assert (got.accuracy, got.weighted_precision, got.weighted_recall, got.f1) == pytest.approx(
        (want["accuracy"], want["precision"], want["recall"], want["f1"]))
    assert K.auc(df, LABEL, "score").first().auc == pytest.approx(want["auc"])


def test_empty_classes(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    row = K.threshold_counts(df, "label", "score").first()
    assert (row.tp, row.fp, row.precision, row.recall) == (0, 0, 0.0, 0.0)
    assert K.auc(df, "label", "score").first().auc == 0.0


@pytest.fixture(scope="module")
def messages(spark):
    texts = [("win free money now", 1.0), ("free prize win", 1.0), ("see you at home", 0.0), ("lunch at noon", 0.0)]
    rows = [(i, *texts[i % 4]) for i in range(80)] + [(80, "", 0.0), (81, None, 0.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, label double")


@pytest.mark.parametrize("batch_docs", [1000, 30])
def test_gradient_rounds(messages, batch_docs):
    grams = hashed_ngrams(messages, "doc_id", "text")
    weights = M.sgd_weights(grams, messages.select("doc_id", "label"), "doc_id", epochs=3, batch_docs=batch_docs)
    scores = M.sgd_scores(grams, weights, messages, "doc_id").join(messages, "doc_id")
    assert scores.count() == 82
    assert K.auc(scores, "label", "probability").first().auc == 1.0


def test_a_gradient_step_is_one_job(messages):
    """Steps grow with the table, so each must stay cheap."""
    grams = hashed_ngrams(messages, "doc_id", "text").persist()
    sc = messages.sparkSession.sparkContext
    sc.setJobGroup("sgd-steps", "")
    M.sgd_weights(grams, messages.select("doc_id", "label"), "doc_id", epochs=20, batch_docs=8)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert 20 * 11 <= len(sc.statusTracker().getJobIdsForGroup("sgd-steps")) < 20 * 11 + 60


def test_gradient_steps_on_repeated_and_null_labels(spark):
    """Rows of a document that has several labels in a batch add up; null labels only count for the batch's size."""
    long = [(1, 5, 2), (1, 9, 1), (2, 5, 1), (3, 7, 4), (4, 9, 3)]
    labels = [(1, 1.0), (1, 1.0), (1, 0.0), (2, 0.0), (3, None), (None, 1.0), (5, 1.0)]
    w = {}
    rows = [(d, y, i, float(n)) for d, y in labels if d for e, i, n in long if e == d]
    rows += [(d, y, -1, 1.0) for d, y in labels if d for e, _ in labels if e == d]
    for epoch in range(3):
        margin, g = {}, {}
        for d, y, i, n in rows:
            margin[d, y] = margin.get((d, y), 0) + n * w.setdefault(i, 0.0)
        for d, y, i, n in rows:
            for (e, label), m in margin.items():
                if e == d and label is not None:
                    g[i] = g.get(i, 0) + n * (1 / (1 + math.exp(-m)) - label)
        w |= {i: w[i] - 0.1 * 0.9**epoch * (x / len(labels) + 1e-5 * w[i]) for i, x in g.items()}
    got = M.sgd_weights(spark.createDataFrame(long, "doc_id long, idx int, n long"),
                        spark.createDataFrame(labels, "doc_id long, label double"), "doc_id", epochs=3)
    assert dict(got.dtypes) == {"idx": "int", "w": "double"}
    assert {r.idx: r.w for r in got.collect()} == pytest.approx(w)


def test_vectors(messages):
    grams = hashed_ngrams(messages, "doc_id", "text")
    first = M.sparse_vectors(grams, "doc_id").filter("doc_id = 0").first().features
    assert first.size == 1 << 18 and first.values.sum() == 7 and list(first.indices) == sorted(first.indices)


def test_cast_prices(spark):
    df = M.cast_prices(spark.createDataFrame([("1.5", "x")], "open string, close string"))
    assert df.collect() == [(1.5, None)]
