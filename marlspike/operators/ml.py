"""Feature vectors, MLlib pipelines, tuning, ablation, and a gradient job on long-form features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from marlspike.functions.hashing import HASH_DIM, slot
from marlspike.functions.maths import LOGIT_CLIP, sigmoid
from marlspike.operators.series import number_rows
from marlspike.session import cut_lineage

# Columns that are not features, the baseline's features, and the
# name parts that put a column into an ablation group.
NOT_FEATURES = (
    "timestamp", "datetime", "target_direction", "target_magnitude", "future_close",
    "hour", "hour_ts", "block_hash", "row_id",
)
BASIC = (
    "return_1h", "ma_24h", "volume_24h", "volatility_24h", "blocks_per_hour", "total_txs", "avg_block_size",
)
TECHNICAL = ("ma_", "bb_", "momentum", "roc", "hl_spread", "price_to_ma")
ONCHAIN = ("block", "tx_", "throughput", "size_trend", "variance")
MARKET = ("volume_", "vwap", "illiquidity")

# Tree and regression settings, and the tuning grid.
SEED = 42
FOREST = dict(numTrees=100, maxDepth=10, minInstancesPerNode=5)
BOOSTING = dict(maxIter=50, maxDepth=5, stepSize=0.1)
REGRESSION = dict(maxIter=100, regParam=0.01, elasticNetParam=0.0)
TEXT_REGRESSION = dict(maxIter=80, regParam=0.01, elasticNetParam=0.0)
GRID = dict(numTrees=(50, 100, 150), maxDepth=(5, 10, 15), minInstancesPerNode=(1, 5, 10))


# --- splits and vectors ----------------------------------------------------

def hash_split(df: DataFrame, key: str, train_percent: int = 80) -> DataFrame:
    """Adds ``split`` from a hash of the key: stable across runs and partitionings."""
    bucket = slot(F.col(key).cast("string"), F.lit(100))
    return df.withColumn("split", F.when(bucket < train_percent, "train").otherwise("test"))


def feature_columns(df: DataFrame) -> list[str]:
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    return [c for c, t in df.dtypes if t in numeric and c not in NOT_FEATURES and c != "rn"]


def cast_prices(df: DataFrame, names: Sequence[str] = ("open", "high", "low", "close", "volume")) -> DataFrame:
    """Price columns stored as text become doubles; what is not a number becomes null."""
    return df.withColumns({n: F.col(n).try_cast("double") for n in names if n in df.columns})


def sparse_vectors(long: DataFrame, id_col: str, dim: int = HASH_DIM) -> DataFrame:
    """``id, features``: at most ``dim`` entries per row, so the list has a fixed bound.

    The vectors are made by Spark's JSON reader, which knows their type: no row passes through Python.
    """
    entries = F.sort_array(F.collect_list(F.struct("idx", F.col("n").cast("double").alias("n"))))
    fields = F.struct(F.lit(0).alias("type"), F.lit(dim).alias("size"), F.col("_e.idx").alias("indices"), F.col("_e.n").alias("values"))
    vector = F.from_json(F.to_json(F.struct(fields.alias("v"))), StructType([StructField("v", VectorUDT())]))["v"]
    return long.groupBy(id_col).agg(entries.alias("_e")).select(id_col, vector.alias("features"))


def scaling_stages(columns: Sequence[str], handle_invalid: str = "skip") -> list:
    return [
        VectorAssembler(inputCols=list(columns), outputCol="raw_features", handleInvalid=handle_invalid),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]


def standardise(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """z-scores of ``columns`` through the assembler and scaler, as plain columns."""
    model = Pipeline(stages=scaling_stages(columns)).fit(df)
    z = model.transform(df).select(*keep, vector_to_array("features").alias("z"))
    return z.select(*keep, *[F.col("z")[i].alias(f"z_{c}") for i, c in enumerate(columns)])


# --- pipelines -------------------------------------------------------------

def classifier(kind: str, label: str, **overrides):
    settings = {"logreg": REGRESSION, "forest": FOREST, "boosting": BOOSTING}[kind] | overrides
    if kind == "logreg":
        return LogisticRegression(featuresCol="features", labelCol=label, **settings)
    cls = RandomForestClassifier if kind == "forest" else GBTClassifier
    return cls(featuresCol="features", labelCol=label, seed=SEED, **settings)


def fit(train: DataFrame, kind: str, columns: Sequence[str], label: str, **overrides) -> PipelineModel:
    return Pipeline(stages=[*scaling_stages(columns), classifier(kind, label, **overrides)]).fit(train)


def evaluate(predictions: DataFrame, label: str) -> dict[str, float]:
    predictions = cut_lineage(predictions.select(label, "prediction", "rawPrediction"))  # read five times
    names = {"accuracy": "accuracy", "weightedPrecision": "precision", "weightedRecall": "recall", "f1": "f1"}
    out = {
        short: MulticlassClassificationEvaluator(labelCol=label, metricName=metric).evaluate(predictions)
        for metric, short in names.items()
    }
    out["auc"] = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC").evaluate(predictions)
    return out


def metric_rows(spark: SparkSession, run_id: str, stage: str, metrics: dict[str, float]) -> DataFrame:
    rows = [(run_id, stage, m, float(v)) for m, v in sorted(metrics.items())]
    return spark.createDataFrame(rows, "run_id string, stage string, metric string, value double")


def importances(model: PipelineModel, columns: Sequence[str], spark: SparkSession, k: int = 10) -> DataFrame:
    """The ``k`` most important features; one row per column of the model."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return (
        spark.createDataFrame(list(zip(columns, weights)), "feature string, importance double")
        .orderBy(F.desc("importance"), "feature").limit(k)
    )


def tune_forest(
    train: DataFrame, columns: Sequence[str], label: str, grid: dict[str, Sequence[int]] = GRID, parallelism: int = 4,
) -> tuple[PipelineModel, DataFrame]:
    """Train/validation search over a forest grid; returns the best model and all scores.

    Assembling and scaling do not depend on the grid and are fitted once.
    """
    forest = RandomForestClassifier(featuresCol="features", labelCol=label, seed=SEED)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(forest.getParam(name), list(values))
    maps = builder.build()
    scaling = Pipeline(stages=scaling_stages(columns)).fit(train)
    scaled = scaling.transform(train).select(label, "features").persist(StorageLevel.MEMORY_AND_DISK)
    search = TrainValidationSplit(
        estimator=forest, estimatorParamMaps=maps,
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"),
        trainRatio=0.8, seed=SEED, parallelism=parallelism,
    )
    found = search.fit(scaled)
    scaled.unpersist()
    rows = [
        (*[int(m[forest.getParam(n)]) for n in grid], float(score))
        for m, score in zip(maps, found.validationMetrics)
    ]
    scores = train.sparkSession.createDataFrame(rows, ", ".join(f"{n} int" for n in grid) + ", auc double")
    return PipelineModel([*scaling.stages, found.bestModel]), scores


def ablation_groups(columns: Sequence[str]) -> dict[str, list[str]]:
    """Feature groups by name parts; a column that fits twice enters once."""

    def having(parts):
        return [c for c in columns if any(p in c for p in parts)]

    basic = [c for c in BASIC if c in columns]
    groups = {
        "basic_only": basic,
        "basic_technical": basic + having(TECHNICAL),
        "basic_onchain": basic + having(ONCHAIN),
        "basic_market": basic + having(MARKET),
        "all_features": list(columns),
    }
    return {g: list(dict.fromkeys(cs)) for g, cs in groups.items() if cs}


def ablation(train: DataFrame, test: DataFrame, columns: Sequence[str], label: str, **overrides) -> DataFrame:
    """One forest per feature group, with its test metrics."""
    settings = dict(numTrees=50, maxDepth=10, minInstancesPerNode=1) | overrides
    rows = []
    for group, names in ablation_groups(columns).items():
        metrics = evaluate(fit(train, "forest", names, label, **settings).transform(test), label)
        rows.append((group, len(names), metrics["auc"], metrics["accuracy"]))
    return train.sparkSession.createDataFrame(rows, "feature_group string, n_features int, auc double, accuracy double")


def text_model(train: DataFrame, label: str = "label", **overrides):
    return LogisticRegression(featuresCol="features", labelCol=label, **(TEXT_REGRESSION | overrides)).fit(train)


# --- mini-batch gradient steps on long-form features ------------------------

BIAS = -1
#: Documents of one gradient step.
BATCH_DOCS = 1024
#: Partitions that the documents of a batch are dealt over.
SLICES = 4
PACKED = ["owner", "y", "c", "copies", "doc", "at", "n"]


def dealt(labels: DataFrame, id_col: str, batch_docs: int = BATCH_DOCS) -> DataFrame:
    """``id, y, batch``: documents in the order of a hash of their id, cut into batches of ``batch_docs``."""
    docs = labels.select(id_col, F.col("label").cast("double").alias("y"))
    order = [F.md5(F.col(id_col).cast("string")), F.col(id_col), F.col("y")]
    return number_rows(docs, order).select(id_col, "y", F.floor(F.col("rn") / batch_docs).alias("batch"))


def _packed(long: DataFrame, docs: DataFrame, id_col: str, known: np.ndarray, batches: int) -> DataFrame:
    """Columns ``PACKED`` of numbers: the documents of a batch in ``SLICES`` partitions, in order of the batches.

    Per document its different labels with their number of rows; then the places of its
    features in ``known`` and their counts. Documents with no known label take no step.
    """
    shared = long.sparkSession.sparkContext.broadcast(known)
    features = long.groupBy(id_col).agg(F.collect_list(F.struct("idx", F.col("n").cast("double").alias("n"))).alias("f"))
    labels = (
        docs.groupBy("batch", id_col, "y").agg(F.count(F.lit(1)).alias("c")).groupBy("batch", id_col)
        .agg(F.sum("c").alias("copies"), F.collect_list(F.when(F.col("y").isNotNull(), F.struct("y", "c"))).alias("ys"))
        .filter(F.size("ys") > 0)
    )
    part = F.col("batch") * SLICES + F.pmod(F.xxhash64(id_col), F.lit(SLICES))
    dealt_out = labels.join(features, id_col).repartitionById(max(1, batches * SLICES), part.cast("int")).select(
        F.col("ys.y").alias("y"), F.col("ys.c").alias("c"), "copies", F.col("f.idx").alias("idx"), F.col("f.n").alias("n"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            y, c, copies, idx, n = r.columns
            docs_of = lambda x: np.repeat(np.arange(len(x)), np.diff(np.asarray(x.offsets)))
            columns = (docs_of(y), np.asarray(y.flatten()), np.asarray(c.flatten(), np.float64), np.asarray(copies, np.float64),
                       docs_of(idx), np.searchsorted(shared.value, np.asarray(idx.flatten())), np.asarray(n.flatten()))
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in columns], PACKED)

    return cut_lineage(dealt_out.mapInArrow(run, ", ".join(f"{c} binary" for c in PACKED)))


def sgd_weights(
    long: DataFrame, labels: DataFrame, id_col: str, epochs: int = 5, batch_docs: int = BATCH_DOCS,
    rate: float = 0.1, decay: float = 0.9, l2: float = 1e-5,
) -> DataFrame:
    """``idx, w`` of a logistic model over ``(id, idx, n)`` rows; ``idx`` -1 is the bias.

    One step per batch of ``batch_docs`` documents, every batch once an epoch. The batches are
    stored once, as numbers, ``SLICES`` partitions each; a step is one job over its batch's
    partitions. As in MLlib's gradient methods, the weights (one per hash bucket) are
    broadcast, and each partition sends back the gradient of the features it has.
    """
    spark = long.sparkSession
    sc = spark.sparkContext
    docs = cut_lineage(dealt(labels, id_col, batch_docs))
    ones = docs.select(id_col, F.lit(BIAS).alias("idx"), F.lit(1).cast("bigint").alias("n"))
    rows = long.select(id_col, "idx", "n").unionByName(ones).filter("idx IS NOT NULL").join(docs.select(id_col), id_col, "left_semi")
    known = np.sort(np.asarray(rows.select("idx").distinct().toArrow()["idx"]))
    n = docs.count()
    batches = -(-n // batch_docs)
    packed = _packed(rows, docs, id_col, known, batches).rdd
    w = np.zeros(len(known))
    for epoch in range(epochs):
        for b in range(batches):
            shared = sc.broadcast(w)
            found = sc.runJob(packed, lambda parts, shared=shared: _gradients(parts, shared.value), range(b * SLICES, (b + 1) * SLICES))
            shared.destroy()
            g, seen = np.zeros(len(w)), np.zeros(len(w), bool)
            for at, part in found:
                g[at] += part
                seen[at] = True
            # weights of features that the batch does not have stay as they are
            size = min(batch_docs, n - b * batch_docs)
            w = np.where(seen, w - rate * decay**epoch * (g / size + l2 * w), w)
    table = pa.table({"idx": pa.array(known, pa.int64()), "w": pa.array(w, pa.float64())})
    return spark.createDataFrame(table).withColumn("idx", F.col("idx").cast(rows.schema["idx"].dataType))


def _gradients(packs: Iterator[Row], w: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the features of some documents, and the sum of their counts times their documents' errors."""
    for pack in packs:
        owner, y, c, copies, doc, at, n = (np.frombuffer(v, t) for v, t in zip(pack, ("i8", "f8", "f8", "f8", "i8", "i8", "f8")))
        margin = np.bincount(doc, n * w[at], len(copies))
        # rows of a document that has a label several times add up in its margin
        error = np.bincount(owner, 1 / (1 + np.exp(-np.clip(margin[owner] * c, -LOGIT_CLIP, LOGIT_CLIP))) - y, len(copies))
        places, local = np.unique(at, return_inverse=True)
        yield places, np.bincount(local, (error * copies)[doc] * n)


def margins(long: DataFrame, weights: DataFrame, id_col: str) -> DataFrame:
    return long.join(weights, "idx").groupBy(id_col).agg(F.sum(F.col("n") * F.col("w")).alias("margin"))


def sgd_scores(long: DataFrame, weights: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """``id, probability`` for every document in ``ids``."""
    ones = ids.select(id_col, F.lit(BIAS).alias("idx"), F.lit(1).cast("bigint").alias("n"))
    rows = long.join(ids.select(id_col), id_col, "left_semi").select(id_col, "idx", "n").unionByName(ones)
    return margins(rows, weights, id_col).select(id_col, sigmoid(F.col("margin")).alias("probability"))
