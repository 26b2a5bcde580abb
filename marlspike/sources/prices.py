"""Price CSVs with differing headers, brought to one bar schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.functions.timefix import epoch_seconds

# Accepted header names of each column, in order of preference.
SYNONYMS = {
    "timestamp": ("timestamp", "Timestamp", "Date", "date", "Open time"),
    "open": ("open", "Open"),
    "high": ("high", "High"),
    "low": ("low", "Low"),
    "close": ("close", "Close"),
    "volume": ("volume", "Volume_(BTC)", "Volume_(Currency)", "Volume"),
    "weighted_price": ("weighted_price", "Weighted_Price"),
}
PRICES = ("open", "high", "low", "close")


def rename_synonyms(df: DataFrame) -> DataFrame:
    """Known columns under their common name; of several synonyms the preferred one is kept."""
    found = {new: next((o for o in old if o in df.columns), None) for new, old in SYNONYMS.items()}
    known = {o for old in SYNONYMS.values() for o in old}
    others = [c for c in df.columns if c not in known]
    return df.select(*[F.col(f"`{o}`").alias(n) for n, o in found.items() if o], *[F.col(f"`{c}`") for c in others])


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """First column of every name; works on frames whose names repeat."""
    seen, names = set(), []
    for i, c in enumerate(df.columns):
        names.append(f"_dup{i}" if c in seen else c)
        seen.add(c)
    return df.toDF(*names).drop(*[n for n in names if n.startswith("_dup")])


def default_column(df: DataFrame, name: str, value: float) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(value))


def harmonise(df: DataFrame) -> DataFrame:
    """``timestamp, open, high, low, close, volume, datetime``; rows with a null are dropped."""
    df = default_column(rename_synonyms(df), "volume", 0.0)
    if "timestamp" not in df.columns:
        raise ValueError(f"no timestamp column among {df.columns}")
    doubles = [F.col(c).cast("string").try_cast("double").alias(c) for c in (*PRICES, "volume")]
    return (
        df.select(epoch_seconds(F.col("timestamp")).alias("timestamp"), *doubles)
        .dropna()
        .withColumn("datetime", F.timestamp_seconds("timestamp"))
    )
