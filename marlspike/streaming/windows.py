"""Event-time counts. Each function takes a batch or a streaming DataFrame.

On a stream the watermark bounds the state and drops late rows; on a batch it
has no effect, so the same function gives the batch result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.operators import series as S

# The two drop-off boxes (name, lon from–to, lat from–to, bounds
# included), the watermark delay, the window width and the alert factor.
BOXES = (
    ("goldman", -74.0145, -74.0115, 40.7125, 40.7155),
    ("citigroup", -74.0095, -74.0055, 40.7190, 40.7225),
)
WATERMARK = "5 minutes"
TREND_WINDOW = "10 minutes"
TREND_FACTOR = 1.5


def box_label(lon: Column, lat: Column, boxes: Sequence[tuple] = BOXES) -> Column:
    """Name of the first box that holds the point, bounds included; null when none does."""
    return F.coalesce(*[
        F.when(lon.between(w, e) & lat.between(s, n), name) for name, w, e, s, n in boxes
    ])


def window_counts(
    df: DataFrame, ts: str, width: str, keys: Sequence[str] = (), delay: str = WATERMARK, name: str = "trip_count",
) -> DataFrame:
    """Tumbling-window counts as ``window_start, window_end, *keys, <name>``."""
    moment = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        moment.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias(name))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, name)
    )


def hourly_counts(df: DataFrame, ts: str) -> DataFrame:
    return window_counts(df, ts, "1 hour").select(F.col("window_start").alias("hour"), "trip_count")


def region_counts(df: DataFrame, ts: str, region: Column) -> DataFrame:
    """Counts per region and hour; rows outside every region are dropped."""
    placed = df.withColumn("region", region).filter(F.col("region").isNotNull())
    return window_counts(placed, ts, "1 hour", ["region"]).select(
        "region", F.col("window_start").alias("hour"), "trip_count")


def trending(windows: DataFrame, factor: float = TREND_FACTOR, block: int = S.BLOCK_ROWS, every: bool = False) -> DataFrame:
    """Windows whose count exceeds ``factor`` times that of the previous non-empty window.

    With ``every``, all windows with ``previous_start`` and whether they ``alert``.
    """
    previous = lambda df, w: df.withColumns({
        "previous_count": F.lag("trip_count", 1).over(w), "previous_start": F.lag("window_start", 1).over(w)})
    found = S.ordered_window(windows, ["window_start"], previous, before=1, block=block)
    alert = F.coalesce(F.col("trip_count") > factor * F.col("previous_count"), F.lit(False))
    if every:
        return found.select("window_start", "trip_count", "previous_count", "previous_start", alert.alias("alert"))
    return found.filter(alert).select("window_start", "trip_count", "previous_count")


def naive_times(df: DataFrame, names: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Timestamps as wall-clock values of the session's (UTC) time zone."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})
