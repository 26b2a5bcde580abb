import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marlspike.sources.files import TRIP_SCHEMA, trip_stream
from marlspike.streaming import alerts as A
from marlspike.streaming import upsert as U
from marlspike.streaming import windows as W
from tests.conftest import rows

START = dt.datetime(2021, 1, 1, 8, 5)
HEADER = "tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,dropoff_longitude,dropoff_latitude"


def trip(i, dropoff=None):
    pickup = START + dt.timedelta(minutes=7 * i)
    dropoff = dropoff or pickup + dt.timedelta(minutes=10)
    return f"{pickup},{dropoff},{1 + i % 3},{2.5 + 0.2 * i},{-74.0135 + 0.004 * (i % 2)},{40.7135 + 0.003 * (i % 3)}"


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("\n".join([HEADER, *lines]) + "\n")
    (folder / f".{name}").rename(folder / name)


@pytest.fixture
def folder(tmp_path):
    for k in range(3):
        write(tmp_path / "in", f"part{k}.csv", [trip(i) for i in range(4 * k, 4 * k + 4)])
    return tmp_path


def clock(value):
    return value.strftime("%H:%M")


def upserted(spark, folder, counts, keys, files, after=None, name="out", merge_every=U.MERGE_EVERY):
    stream = counts(trip_stream(spark, str(folder / "in"), files))
    table = U.KeyedTable(spark, str(folder / name), keys, merge_every)
    U.start_upsert(stream, table, str(folder / f"{name}-checkpoint"), after and after(table)).awaitTermination()
    return table.current()


def naive(df, *names):
    return W.naive_times(df, names)


@pytest.mark.parametrize("files", [1, None])
def test_hourly(spark, folder, files):
    got = naive(upserted(spark, folder, lambda s: W.hourly_counts(s, "tpep_pickup_datetime"), ["hour"], files), "hour")
    assert sorted((clock(r.hour), r.trip_count) for r in got.collect()) == [("08:00", 8), ("09:00", 4)]


def test_region(spark, folder):
    box = W.box_label(F.col("dropoff_longitude"), F.col("dropoff_latitude"))
    got = naive(upserted(
        spark, folder, lambda s: W.region_counts(s, "tpep_dropoff_datetime", box), ["region", "hour"], 1), "hour")
    assert sorted((r.region, clock(r.hour), r.trip_count) for r in got.collect()) == [
        ("citigroup", "08:00", 1), ("citigroup", "09:00", 1), ("goldman", "08:00", 2)]


WINDOWS = {"08:10": 1, "08:20": 2, "08:30": 1, "08:40": 1, "08:50": 2, "09:00": 1, "09:10": 2, "09:20": 1, "09:30": 1}


def trend(s):
    return W.window_counts(s, "tpep_dropoff_datetime", W.TREND_WINDOW)


def test_windows_alerts_and_restart(spark, folder):
    """Counts and alerts after every file in its own batch, then more input through the same checkpoint."""
    alerts = A.alert_table(spark, str(folder / "alerts"), 2)

    def state():
        table = naive(upserted(spark, folder, trend, A.WINDOW_KEYS, 1, lambda w: A.alert_writer(w, alerts), "w", 2), "window_start")
        found = naive(A.latest_alerts(alerts), "window_start")
        return {clock(r.window_start): r.trip_count for r in table.collect()}, sorted(clock(r.window_start) for r in found.collect())

    assert state() == (WINDOWS, ["08:20", "08:50", "09:10"])
    batch = alerts.manifest()["batch"]
    write(folder / "in", "part3.csv", [trip(12), trip(12), trip(12)])
    counts, alerted = state()
    assert counts["09:30"] == 4 and alerted == ["08:20", "08:50", "09:10", "09:30"]
    assert alerts.manifest()["batch"] > batch
    assert counts == {clock(r.window_start): r.trip_count for r in naive(
        trend(spark.read.schema(TRIP_SCHEMA).option("header", True).csv(str(folder / "in"))), "window_start").collect()}


def test_alerts_are_raised_and_withdrawn_incrementally(spark, tmp_path):
    """Random batches, late windows between others among them: after each, alerts equal those of the whole table."""
    rnd = random.Random(6)
    windows = U.KeyedTable(spark, str(tmp_path / "w"), A.WINDOW_KEYS, 3)
    alerts = A.alert_table(spark, str(tmp_path / "a"), 3)
    after, counts, withdrawn = A.alert_writer(windows, alerts), {}, 0
    for n in range(7):
        changed = {rnd.randrange(6 * n, 6 * n + 12) if rnd.random() < 0.8 else rnd.randrange(0, 60) for _ in range(5)} | ({2000} if n == 5 else set())
        for k in changed:
            counts[k] = counts.get(k, 0) + rnd.randrange(1, 6)
        start = lambda k: dt.datetime(2021, 1, 1) + dt.timedelta(minutes=10 * k)
        batch = spark.createDataFrame([(start(k), start(k + 1), counts[k]) for k in changed], "window_start timestamp, window_end timestamp, trip_count long")
        for _ in range(2 if n % 3 == 0 else 1):  # some batches are replayed
            windows.write(batch, n)
            after(batch, n)
        order = sorted(counts)
        want = sorted((start(b), counts[b], counts[a]) for a, b in zip(order, order[1:]) if counts[b] > 1.5 * counts[a])
        assert rows(A.latest_alerts(alerts)) == sorted(want, key=repr)
        log = alerts.log(alerts.manifest())
        withdrawn += log.filter("withdrawn").count()
        assert len(alerts.manifest()["folders"]) <= 4 and len(list((tmp_path / "a").glob("*-0*"))) <= 8
    assert withdrawn


def test_late_rows_are_dropped(spark, folder):
    upserted(spark, folder, trend, A.WINDOW_KEYS, 1)
    late = dt.datetime(2021, 1, 1, 8, 21)
    write(folder / "in", "part3.csv", [trip(11, late), trip(11, dt.datetime(2021, 1, 1, 9, 36))])
    got = naive(upserted(spark, folder, trend, A.WINDOW_KEYS, 1), "window_start")
    assert {clock(r.window_start): r.trip_count for r in got.collect()} == WINDOWS | {"09:30": 2}


def test_append_writes_closed_windows_once(spark, folder):
    stream = trend(trip_stream(spark, str(folder / "in"), 1))
    U.start_append(stream, str(folder / "app"), str(folder / "app-checkpoint")).awaitTermination()
    got = naive(spark.read.parquet(str(folder / "app")), "window_start")
    # The watermark stands at 09:27, so the windows from 09:20 on are still open.
    assert {clock(r.window_start): r.trip_count for r in got.collect()} == {
        k: v for k, v in WINDOWS.items() if k < "09:20"}


def test_keyed_table_is_bounded_and_replays(spark, tmp_path):
    """Whatever the number of batches, few folders are read and kept; a batch may be written again before or after its manifest."""
    table = U.KeyedTable(spark, str(tmp_path / "t"), ["k"], merge_every=3, drop="n < 0")
    want = {}
    for b in range(14):
        changes = {f"k{(b * 5 + i) % 7}": -1 if (b + i) % 5 == 0 else b * 10 + i for i in range(3)}
        df = spark.createDataFrame(list(changes.items()), "k string, n int")
        if b % 4 == 1:  # written, but the job died before its manifest
            df.withColumn("batch", F.lit(b).cast("long")).write.parquet(str(tmp_path / "t" / f"delta-{b:012d}"))
        for _ in range(1 + (b % 3 == 2)):
            table.write(df, b)
        want |= changes
        assert {r.k: r.n for r in table.current().collect() if r.n >= 0} == {k: n for k, n in want.items() if n >= 0}
        assert len(table.manifest()["folders"]) <= 4
    assert len(list((tmp_path / "t").glob("*-0*"))) <= 9 and len(list((tmp_path / "t" / "manifest").glob("[0-9]*.json"))) == 2
    assert not list((tmp_path / "t").glob("draft-*"))
    assert rows(table.current(before=13).select("k")) != [] and table.manifest(13)["batch"] == 12


def test_empty_keyed_table(spark, tmp_path):
    table = U.KeyedTable(spark, str(tmp_path / "t"), ["k"])
    assert table.current(schema="k string, n int").count() == 0 and table.manifest() == {"batch": -1, "folders": []}
    table.write(spark.createDataFrame([], "k string, n int"), 0)
    assert rows(table.current()) == []


def test_trending_ignores_block_limits(spark):
    df = spark.range(50).selectExpr("timestamp_seconds(id * 600) AS window_start", "1 + id % 2 AS trip_count")
    got = W.trending(df, block=4)
    assert got.count() == 25 and {(r.trip_count, r.previous_count) for r in got.collect()} == {(2, 1)}


def test_box_bounds(spark):
    df = spark.createDataFrame([(-74.0095, 40.7190), (-74.0145, 40.7155), (-74.0, 40.7), (None, 40.72)], "x double, y double")
    assert [r[0] for r in df.select(W.box_label(F.col("x"), F.col("y"))).collect()] == ["citigroup", "goldman", None, None]
