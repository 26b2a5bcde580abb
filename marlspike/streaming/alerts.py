"""Trend alerts kept up to date while a windowed count is streaming."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.streaming.upsert import KeyedTable
from marlspike.streaming.windows import TREND_FACTOR, trending

WINDOW_KEYS = ["window_start", "window_end"]
ALERT_KEYS = ["window_start"]
ALERT_SCHEMA = "window_start timestamp, trip_count long, previous_count long, withdrawn boolean"
#: Where to look for the non-empty window before the first changed one; doubled until it is found.
FIRST_LOOK = timedelta(days=1)


def alert_table(spark, path: str, merge_every: int) -> KeyedTable:
    """Alerts by window; a merge forgets the withdrawn ones."""
    return KeyedTable(spark, path, ALERT_KEYS, merge_every, drop="withdrawn")


def _around(windows: DataFrame, low, oldest) -> DataFrame:
    """The windows from the last non-empty one before ``low`` on. Only as much of the table is read as that takes."""
    look = FIRST_LOOK
    while True:
        near = windows.filter(F.col("window_start") >= F.lit(low - look))
        if low - look <= oldest or not near.filter(F.col("window_start") < F.lit(low)).isEmpty():
            return near
        look *= 2


def alert_writer(windows: KeyedTable, alerts: KeyedTable, factor: float = TREND_FACTOR) -> Callable[[DataFrame, int], None]:
    """``after_batch`` step: alerts of the windows that a micro-batch changed and of those right after them.

    A window's alert depends on its own count and on that of the non-empty window before,
    so a changed window can raise or end two alerts. An alert that no longer holds is
    withdrawn by a row that says so. Alerts elsewhere are not looked at.
    """

    seen: list = []  # the first window of all, read once a start and then kept up to date

    def after(batch: DataFrame, batch_id: int) -> None:
        low = batch.agg(F.min("window_start")).first()[0]
        if low is None:
            return
        table = windows.current().select(*WINDOW_KEYS, "trip_count")
        seen[:] = [min([low, *seen]) if seen else windows.log(windows.manifest()).agg(F.min("window_start")).first()[0]]
        near = _around(table, low, seen[0])
        judged = trending(near, factor, every=True)  # one row a window, with its predecessor
        changed = batch.select("window_start", F.lit(True).alias("changed")).distinct()
        before = changed.select(F.col("window_start").alias("previous_start"), F.col("changed").alias("previous_changed"))
        touched = judged.join(changed, "window_start", "left").join(before, "previous_start", "left").filter("changed OR previous_changed")
        standing = alerts.current(before=batch_id, schema=ALERT_SCHEMA).filter("NOT withdrawn").select("window_start", F.lit(True).alias("standing"))
        found = touched.join(standing, "window_start", "left").filter("alert OR standing").select(
            "window_start", "trip_count", "previous_count", (~F.col("alert")).alias("withdrawn"))
        alerts.write(found, batch_id)

    return after


def latest_alerts(alerts: KeyedTable) -> DataFrame:
    """Alerts as of the last micro-batch."""
    return alerts.current(schema=ALERT_SCHEMA).filter("NOT withdrawn").drop("withdrawn")
