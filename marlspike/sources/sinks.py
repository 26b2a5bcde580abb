"""Sinks: CSV, TSV and parquet files, metric logs, fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with headers, one per partition, for results of any size."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").csv(path)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append ``run_id, stage, metric, value`` rows, stamped with the time of writing."""
    stamped = metrics.select("run_id", "stage", "metric", "value", F.current_timestamp().alias("timestamp"))
    stamped.write.mode("append").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
