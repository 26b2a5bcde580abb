"""Registered event-time queries: batch forms, and the same counts run as streams.

``events.ts`` is the trip time. Regions are boxes over ``value`` and ``user_id``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marlspike.plans.registry import query
from marlspike.session import names, rename, scratch_path
from marlspike.sources.tables import table
from marlspike.streaming import alerts as A
from marlspike.streaming import upsert as U
from marlspike.streaming import windows as W

REGIONS = (("north", 0.0, 25.0, 0.0, 60.0), ("south", 20.0, 80.0, 40.0, 120.0))

REGION_SQL = """CASE WHEN value BETWEEN 0 AND 25 AND user_id BETWEEN 0 AND 60 THEN 'north'
                     WHEN value BETWEEN 20 AND 80 AND user_id BETWEEN 40 AND 120 THEN 'south' END"""
HOURLY = "SELECT date_trunc('hour', ts) AS hour, count(*) AS trip_count FROM events GROUP BY 1"
REGIONAL = f"""SELECT region, date_trunc('hour', ts) AS hour, count(*) AS trip_count
    FROM (SELECT ts, {REGION_SQL} AS region FROM events) WHERE region IS NOT NULL GROUP BY ALL"""


def _windows_sql(width):
    return f"""SELECT time_bucket(INTERVAL '{width}', ts) AS window_start,
      time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end, count(*) AS trip_count
      FROM events GROUP BY ALL"""


ALERTS = f"""
    WITH c AS ({_windows_sql('10 minutes')}),
    p AS (SELECT window_start, trip_count, lag(trip_count) OVER (ORDER BY window_start) AS previous_count FROM c)
    SELECT * FROM p WHERE trip_count > 1.5 * previous_count
"""


def _events(spark, sf):
    return table(spark, sf, "events")


def _stream(spark, sf):
    """The events file as a stream over its folder."""
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _region():
    return W.box_label(F.col("value"), F.col("user_id").cast("double"), REGIONS)


@query("flt_bbox", f"SELECT event_id, {REGION_SQL} AS region FROM events")
def flt_bbox(spark, sf):
    return _events(spark, sf).select("event_id", _region().alias("region"))


@query("st_hourly_count", HOURLY)
def st_hourly_count(spark, sf):
    return W.naive_times(W.hourly_counts(_events(spark, sf), "ts"), ["hour"])


@query("st_region_count", REGIONAL)
def st_region_count(spark, sf):
    return W.naive_times(W.region_counts(_events(spark, sf), "ts", _region()), ["hour"])


@query("st_watermark_window", _windows_sql("1 hour"))
def st_watermark_window(spark, sf):
    return W.naive_times(W.window_counts(_events(spark, sf), "ts", "1 hour"), A.WINDOW_KEYS)


@query("st_trending_window", _windows_sql("10 minutes"))
def st_trending_window(spark, sf):
    return W.naive_times(W.window_counts(_events(spark, sf), "ts", W.TREND_WINDOW), A.WINDOW_KEYS)


@query("st_trending_alert", ALERTS)
def st_trending_alert(spark, sf):
    counts = W.window_counts(_events(spark, sf), "ts", W.TREND_WINDOW)
    return W.naive_times(W.trending(counts), ["window_start"])


def _run_update(spark, counts, keys):
    changed = U.KeyedTable(spark, scratch_path(spark, "upsert"), keys)
    U.start_upsert(counts, changed, scratch_path(spark, "stream")).awaitTermination()
    return changed.current()


@query("st_hourly_count_stream", HOURLY)
def st_hourly_count_stream(spark, sf):
    return W.naive_times(_run_update(spark, W.hourly_counts(_stream(spark, sf), "ts"), ["hour"]), ["hour"])


@query("st_region_count_stream", REGIONAL)
def st_region_count_stream(spark, sf):
    counts = W.region_counts(_stream(spark, sf), "ts", _region())
    return W.naive_times(_run_update(spark, counts, ["region", "hour"]), ["hour"])


@query("st_output_update", _windows_sql("10 minutes"))
def st_output_update(spark, sf):
    counts = W.window_counts(_stream(spark, sf), "ts", W.TREND_WINDOW)
    return W.naive_times(_run_update(spark, counts, A.WINDOW_KEYS), A.WINDOW_KEYS)


@query("st_output_append", f"""
    SELECT * FROM ({_windows_sql('10 minutes')})
    WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '5 minutes' FROM events)
""")
def st_output_append(spark, sf):
    """Append mode: the windows the watermark has closed."""
    path = scratch_path(spark, "append")
    counts = W.window_counts(_stream(spark, sf), "ts", W.TREND_WINDOW)
    U.start_append(counts, path, scratch_path(spark, "stream")).awaitTermination()
    return W.naive_times(spark.read.parquet(path), A.WINDOW_KEYS)


@query("st_trending_alert_stream", ALERTS)
def st_trending_alert_stream(spark, sf):
    windows = U.KeyedTable(spark, scratch_path(spark, "windows"), A.WINDOW_KEYS)
    alerts = A.alert_table(spark, scratch_path(spark, "alerts"), windows.merge_every)
    counts = W.window_counts(_stream(spark, sf), "ts", W.TREND_WINDOW)
    U.start_upsert(counts, windows, scratch_path(spark, "stream"), A.alert_writer(windows, alerts)).awaitTermination()
    return W.naive_times(A.latest_alerts(alerts), ["window_start"])


# --- events that arrive in several deliveries --------------------------------
#
# A delivery holds a slice of the time span, and the events of the slice two before it
# that came late. Every delivery is streamed by a start of its own, so the job stops and
# resumes from its checkpoint in between. Rows whose window the watermark has passed by
# then are dropped, which the oracles state: the watermark is five minutes behind the
# latest event of all earlier deliveries.

DELIVERIES, LATE_BY, LATE_EACH = 5, 2, 40

DELIVERED = f"""
    span AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
    d AS (SELECT events.*, least({DELIVERIES - 1}, ({DELIVERIES} * (epoch_us(ts) - lo)) // (hi - lo + 1)
            + CASE WHEN event_id % {LATE_EACH} = 0 THEN {LATE_BY} ELSE 0 END)::INTEGER AS delivery FROM events, span),
    marks AS (SELECT delivery, date_trunc('millisecond', max(max(ts)) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
              - INTERVAL '5 minutes' AS mark FROM d GROUP BY delivery)
"""


def _in_time(width):
    return f"""{DELIVERED}, kept AS (SELECT d.*, time_bucket(INTERVAL '{width}', ts) AS window_start FROM d JOIN marks USING (delivery)
        WHERE mark IS NULL OR time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' > mark)"""


def deliveries(events):
    """``events`` with the delivery that brings each."""
    span = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    late = F.when(F.col("event_id") % LATE_EACH == 0, LATE_BY).otherwise(0)
    part = F.floor((micros("ts") - micros("lo")) * DELIVERIES / (micros("hi") - micros("lo") + 1))
    # one row
    return events.join(F.broadcast(span)).withColumn("delivery", F.least(F.lit(DELIVERIES - 1), part + late).cast("int")).drop("lo", "hi")


def streamed(spark, sf, form, start):
    """Deliver the events one folder after the other, and let ``start(stream)`` run on what is there each time."""
    staged, inbox = scratch_path(spark, "staged"), scratch_path(spark, "inbox")
    events = deliveries(_events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")))
    writer = events.write.partitionBy("delivery").option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    (writer.option("header", True).csv(staged) if form == "csv" else writer.parquet(staged))
    schema = events.drop("delivery").schema
    for name in (n for n in names(spark, staged) if n.startswith("delivery=")):
        rename(spark, f"{staged}/{name}", f"{inbox}/{name.replace('=', '-')}")
        reader = spark.readStream.schema(schema)
        stream = reader.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{inbox}/*") if form == "csv" else reader.parquet(f"{inbox}/*")
        start(stream).awaitTermination()


@query("src_stream_csv", "SELECT event_id, ts, user_id, event_type, value FROM events")
def src_stream_csv(spark, sf):
    """CSV deliveries read as a stream and appended to a table: every row once, over four restarts."""
    target, checkpoint = scratch_path(spark, "appended"), scratch_path(spark, "stream")
    streamed(spark, sf, "csv", lambda s: U.start_append(s.select("event_id", "ts", "user_id", "event_type", "value"), target, checkpoint))
    return W.naive_times(spark.read.parquet(target), ["ts"])


@query("st_trigger_once", f"WITH {DELIVERED} SELECT delivery AS start, count(*) AS n_rows FROM d GROUP BY delivery")
def st_trigger_once(spark, sf):
    """Each start takes exactly what has arrived since the last one, and ends."""
    path, checkpoint = scratch_path(spark, "starts"), scratch_path(spark, "stream")
    starts = U.KeyedTable(spark, path, ["start"])

    def sink(batch, batch_id):
        starts.write(batch.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(batch_id).alias("start"), "n_rows"), batch_id)

    streamed(spark, sf, "parquet", lambda s: s.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return starts.current()


@query("st_late_data", f"WITH {_in_time('1 hour')} SELECT window_start AS hour, count(*) AS trip_count FROM kept GROUP BY 1")
def st_late_data(spark, sf):
    """Hourly counts without the events that came after the watermark had passed their hour."""
    changed, checkpoint = U.KeyedTable(spark, scratch_path(spark, "upsert"), ["hour"], merge_every=2), scratch_path(spark, "stream")
    streamed(spark, sf, "parquet", lambda s: U.start_upsert(W.hourly_counts(s, "ts"), changed, checkpoint))
    return W.naive_times(changed.current(), ["hour"])


@query("st_checkpoint", f"""
    WITH {_in_time('10 minutes')} SELECT window_start, window_start + INTERVAL '10 minutes' AS window_end, count(*) AS trip_count FROM kept
    WHERE window_start + INTERVAL '10 minutes' <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '5 minutes' FROM events) GROUP BY ALL
""")
def st_checkpoint(spark, sf):
    """Append mode over restarts: state and watermark come back from the checkpoint, each closed window is written once."""
    target, checkpoint = scratch_path(spark, "appended"), scratch_path(spark, "stream")
    streamed(spark, sf, "parquet", lambda s: U.start_append(W.window_counts(s, "ts", W.TREND_WINDOW), target, checkpoint))
    return W.naive_times(spark.read.parquet(target), A.WINDOW_KEYS)


@query("snk_foreach_batch", f"""
    WITH {_in_time('10 minutes')}, c AS (SELECT window_start, count(*) AS trip_count FROM kept GROUP BY ALL),
    p AS (SELECT *, lag(trip_count) OVER (ORDER BY window_start) AS previous_count FROM c)
    SELECT * FROM p WHERE trip_count > 1.5 * previous_count
""")
def snk_foreach_batch(spark, sf):
    """Windows and their alerts kept by ``foreachBatch`` over several deliveries, with withdrawals and log merges."""
    windows = U.KeyedTable(spark, scratch_path(spark, "windows"), A.WINDOW_KEYS, merge_every=2)
    alerts = A.alert_table(spark, scratch_path(spark, "alerts"), merge_every=2)
    checkpoint, after = scratch_path(spark, "stream"), A.alert_writer(windows, alerts)
    streamed(spark, sf, "parquet", lambda s: U.start_upsert(W.window_counts(s, "ts", W.TREND_WINDOW), windows, checkpoint, after))
    return W.naive_times(A.latest_alerts(alerts), ["window_start"])
