import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marlspike.operators import features as X
from marlspike.operators import series as S
from tests.conftest import rows


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(5)
    # A third of the rows share one time, so only the tie-break can spread them.
    data = [(i, 500 if i % 3 == 0 else rng.randrange(1000), float(rng.randrange(1, 500))) for i in range(600)]
    return spark.createDataFrame(data, "id int, t int, v double").repartition(5).persist()


def test_row_numbers(series):
    got = {r.id: r.rn for r in S.number_rows(series, ["t", "id"]).collect()}
    order = sorted(((r.t, r.id) for r in series.collect()))
    assert got == {i: n for n, (_, i) in enumerate(order)}


def test_running_sum(series):
    got = {r.id: r.s for r in S.running_sum(series, ["t", "id"], "v", "s").collect()}
    total, want = 0.0, {}
    for r in sorted(series.collect(), key=lambda r: (r.t, r.id)):
        total += r.v
        want[r.id] = total
    assert got == pytest.approx(want)


@pytest.mark.parametrize("block", [1, 7, 100, 5000])
def test_blocks_equal_the_global_window(series, block):
    def compute(df, w):
        return df.withColumns({
            "l": F.lag("v", 1).over(w), "f": F.lead("v", 60).over(w),
            "a": F.avg("v").over(w.rowsBetween(-24, 0)), "s": F.stddev_samp("v").over(w.rowsBetween(-24, 0)),
        })

    got = S.ordered_window(series, ["t", "id"], compute, before=24, after=60, block=block)
    want = compute(series, Window.orderBy("t", "id"))
    digits = [F.round(c, 9).alias(c) for c in ("l", "f", "a", "s")]
    assert rows(got.select("id", *digits)) == rows(want.select("id", *digits))


@pytest.mark.parametrize("block", [30, 400])
def test_all_features_do_not_depend_on_the_block(spark, block):
    rng = random.Random(1)
    prices = spark.createDataFrame(
        [(3600 * i, *(float(rng.randrange(50, 90)) for _ in range(4)), float(rng.randrange(5))) for i in range(300)],
        "timestamp long, open double, high double, low double, close double, volume double",
    ).withColumn("hour_ts", F.timestamp_seconds("timestamp").cast("timestamp_ntz"))
    blocks = spark.createDataFrame(
        [(3600 * rng.randrange(300) + 5, rng.randrange(9), float(rng.randrange(1, 9))) for _ in range(500)],
        "s long, tx_count long, size double").withColumn("ts", F.timestamp_seconds("s"))
    numbered = S.number_rows(prices, ["timestamp"])

    def result(size):
        df = X.all_features(numbered, blocks, block=size)
        return rows(df.select(*[F.round(c, 8) if t == "double" else F.col(c) for c, t in df.dtypes]))

    got = result(block)
    assert len(got) == 240 and got == result(10_000)
    assert any(r["blocks_count"] == 0 for r in X.all_features(numbered, blocks).collect())


@pytest.mark.parametrize("block", [64, None])
def test_exponential_average(spark, block):
    rng = random.Random(2)
    values = [float(rng.randrange(1, 100)) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(values)), "rn long, close double")
    got = {r.rn: r for r in X.oscillators(df, block=block).collect()}
    for span, name in ((12, "ema_12"), (26, "ema_26")):
        a, e = 2 / (span + 1), values[0]
        for i, x in enumerate(values):
            e = e if i == 0 else a * x + (1 - a) * e
            assert got[i][name] == pytest.approx(e, rel=1e-9)


def test_split(spark):
    df = spark.range(0, 101).withColumnRenamed("id", "rn")
    counts = {r.split: r["count"] for r in S.chronological_split(df).groupBy("split").count().collect()}
    assert counts == {"train": 80, "test": 21}
