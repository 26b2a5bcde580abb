"""Classification metrics computed from (label, score) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.operators.series import running_sum


def majority(df: DataFrame, label: str) -> DataFrame:
    """The most frequent label, its count and its share of all rows."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.orderBy(F.desc("n"), "label").limit(1).select(
        "label", "n", F.round(F.col("n") / total, 6).alias("share")
    )


def threshold_counts(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """tp, fp, fn, tn, precision and recall at a score threshold; 0 where a ratio has no base."""
    actual, predicted = F.col(label) == 1, F.col(score) >= threshold
    cells = df.agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )
    zero = F.lit(0.0)
    return cells.withColumn(
        "precision", F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), zero)
    ).withColumn("recall", F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), zero))


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by rank sum, ties given their average rank.

    Rows are first counted per distinct score; ranks are a running sum over the
    distinct scores, computed in range partitions.
    """
    per_score = df.groupBy(F.col(score).alias("_score")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("p"))
    ranked = running_sum(per_score, ["_score"], "n", "upto")
    mean_rank = F.col("upto") - (F.col("n") - 1) / 2
    sums = ranked.agg(
        F.sum(F.col("p") * mean_rank).alias("rank_sum"),
        F.sum("p").alias("positives"), F.sum(F.col("n") - F.col("p")).alias("negatives"),
    )
    p, n = F.col("positives").cast("double"), F.col("negatives").cast("double")
    return sums.select(
        "positives", "negatives",
        F.coalesce(F.try_divide(F.col("rank_sum") - p * (p + 1) / 2, p * n), F.lit(0.0)).alias("auc"),
    )


def classification(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, weighted precision and recall, and weighted F1, from the confusion cells."""
    cells = df.groupBy(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("z")).agg(
        F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("y") == F.col("z"), F.col("n")).otherwise(0)
    sides = cells.select(
        F.explode(F.array(
            F.struct(F.col("y").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("hit")),
            F.struct(F.col("z").alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hit")),
        )).alias("s")
    ).select("s.*")
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hit", F.col("predicted")), zero)
    recall = F.coalesce(F.try_divide("hit", F.col("actual")), zero)
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), zero)
    classes = sides.groupBy("class").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    total = F.sum("actual")
    return classes.agg(
        (F.sum("hit") / total).alias("accuracy"),
        (F.sum(precision * F.col("actual")) / total).alias("weighted_precision"),
        (F.sum(recall * F.col("actual")) / total).alias("weighted_recall"),
        (F.sum(f1 * F.col("actual")) / total).alias("f1"),
    )
