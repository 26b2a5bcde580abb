"""Registered window and feature queries over the ``events`` stream.

Row windows run over single events; the feature table runs over hourly bars of
``value``. Blocks are the events themselves, with ``props.k`` as transaction
count and ``value`` as size.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marlspike.functions.maths import relative_change
from marlspike.operators import features as X
from marlspike.operators import series as S
from marlspike.plans.registry import query
from marlspike.sources.tables import table

def digits(name):
    """Averages of cents over 32, 64 or 128 rows end in a 5 as late as the ninth decimal and keep nine."""
    averaged = name.startswith(("ma_", "bb_", "volume_ma", "avg_", "ema", "tx_thr")) and name != "bb_position"
    return 9 if averaged else 6


def rounded(df):
    """Doubles rounded for comparison; adding zero turns a negative zero positive."""
    return df.select(*[
        (F.round(c, digits(c)) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


def cols(*names, plain=()):
    return ", ".join([*plain, *[f"round({n}, {digits(n)}) + 0.0::DOUBLE AS {n}" for n in names]])


# --- row windows over events -----------------------------------------------

def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "value")


ORDER = ["ts", "event_id"]


@query("win_lag_ratio", f"""
    WITH l AS (SELECT event_id, value v, lag(value, 1) OVER w l1, lag(value, 6) OVER w l6,
                      lag(value, 12) OVER w l12, lag(value, 24) OVER w l24
               FROM events WINDOW w AS (ORDER BY ts, event_id)),
    r AS (SELECT event_id, (v - l1) / nullif(l1, 0) r1, (v - l6) / nullif(l6, 0) * 100 r6,
                 (v - l12) / nullif(l12, 0) r12, (v - l24) / nullif(l24, 0) r24 FROM l)
    SELECT {cols('r1', 'r6', 'r12', 'r24', plain=['event_id'])} FROM r
""")
def win_lag_ratio(spark, sf):
    def compute(df, w):
        v = F.col("value")
        r = {k: relative_change(v, F.lag("value", k).over(w)) for k in (1, 6, 12, 24)}
        return df.withColumns({"r1": r[1], "r6": r[6] * 100, "r12": r[12], "r24": r[24]})

    return rounded(S.ordered_window(_events(spark, sf), ORDER, compute, before=24).select(
        "event_id", "r1", "r6", "r12", "r24"))


@query("win_lag_diff", """
    WITH h AS (SELECT date_trunc('hour', ts) AS hour_ts, count(*) AS n FROM events GROUP BY 1)
    SELECT hour_ts, n, n - lag(n) OVER (ORDER BY hour_ts) AS change FROM h
""")
def win_lag_diff(spark, sf):
    hours = table(spark, sf, "events").groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_ts")).agg(F.count(F.lit(1)).alias("n"))
    return S.ordered_window(
        hours, ["hour_ts"],
        lambda df, w: df.withColumn("change", F.col("n") - F.lag("n", 1).over(w)), before=1,
    ).select("hour_ts", "n", "change")


@query("win_lead", """
    SELECT event_id, lead(value, 60) OVER (ORDER BY ts, event_id) AS future_value FROM events
""")
def win_lead(spark, sf):
    return S.ordered_window(
        _events(spark, sf), ORDER,
        lambda df, w: df.withColumn("future_value", F.lead("value", 60).over(w)), before=0, after=60,
    ).select("event_id", "future_value")


def _moving(agg, name, spans):
    return lambda df, w: df.withColumns({f"{name}_{n}": agg("value").over(w.rowsBetween(-n, 0)) for n in spans})


SPANS = (6, 12, 24, 48, 168)


def _moving_sql(agg, name, spans):
    inner = ", ".join(
        f"{agg}(value) OVER (ORDER BY ts, event_id ROWS BETWEEN {n} PRECEDING AND CURRENT ROW) AS {name}_{n}" for n in spans)
    return f"WITH m AS (SELECT event_id, {inner} FROM events) SELECT {cols(*[f'{name}_{n}' for n in spans], plain=['event_id'])} FROM m"


@query("win_moving_avg", _moving_sql("avg", "ma", SPANS))
def win_moving_avg(spark, sf):
    df = S.ordered_window(_events(spark, sf), ORDER, _moving(F.avg, "ma", SPANS), before=max(SPANS))
    return rounded(df.select("event_id", *[f"ma_{n}" for n in SPANS]))


@query("win_moving_sum", _moving_sql("sum", "total", (6, 24)))
def win_moving_sum(spark, sf):
    df = S.ordered_window(_events(spark, sf), ORDER, _moving(F.sum, "total", (6, 24)), before=24)
    return rounded(df.select("event_id", "total_6", "total_24"))


@query("win_moving_std", _moving_sql("stddev_samp", "sd", (12, 24, 48)))
def win_moving_std(spark, sf):
    df = S.ordered_window(_events(spark, sf), ORDER, _moving(F.stddev_samp, "sd", (12, 24, 48)), before=48)
    return rounded(df.select("event_id", "sd_12", "sd_24", "sd_48"))


@query("win_prev_compare", """
    WITH c AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, count(*) AS n FROM events GROUP BY 1)
    SELECT window_start, n, lag(n) OVER (ORDER BY window_start) AS previous FROM c
""")
def win_prev_compare(spark, sf):
    counts = table(spark, sf, "events").groupBy(F.window("ts", "10 minutes").getField("start").alias("window_start")).agg(
        F.count(F.lit(1)).alias("n"))
    return S.ordered_window(
        counts, ["window_start"], lambda df, w: df.withColumn("previous", F.lag("n", 1).over(w)), before=1,
    ).select("window_start", "n", "previous")


@query("win_row_index", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS rn FROM events")
def win_row_index(spark, sf):
    return S.number_rows(_events(spark, sf), ORDER).select("event_id", "rn")


# --- hourly bars and features ----------------------------------------------

BARS = """
    bars AS (SELECT epoch(date_trunc('hour', ts))::BIGINT AS timestamp, date_trunc('hour', ts) AS hour_ts,
               arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, ts) AS close, sum(value) AS volume
             FROM events GROUP BY ALL),
    blocks AS (SELECT ts, (props::JSON->>'$.k')::BIGINT AS tx_count, value AS size FROM events),
    hours0 AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS blocks_count, sum(tx_count)::BIGINT AS total_txs,
               avg(size) AS avg_block_size, stddev_samp(size) AS std_block_size,
               max(tx_count) AS max_txs_per_block, min(tx_count) AS min_txs_per_block FROM blocks GROUP BY 1),
    hours1 AS (SELECT *, blocks_count - lag(blocks_count) OVER (ORDER BY hour) AS blocks_per_hour_change,
               total_txs / nullif(blocks_count, 0) AS tx_throughput,
               avg(avg_block_size) OVER (ORDER BY hour ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS avg_block_size_6h,
               (max_txs_per_block - min_txs_per_block) / nullif(total_txs, 0) AS tx_variance_ratio FROM hours0),
    hours AS (SELECT *, (avg_block_size - avg_block_size_6h) / nullif(avg_block_size_6h, 0) AS block_size_trend FROM hours1)
"""


def _w(n):
    return f"OVER (ORDER BY timestamp ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


FEATURES = f"""
    {BARS},
    f1 AS (SELECT *, close / nullif(lag(close) OVER o, 0) - 1 AS return_1h,
        (close - lag(close, 12) OVER o) / nullif(lag(close, 12) OVER o, 0) AS momentum_12h,
        (close - lag(close, 24) OVER o) / nullif(lag(close, 24) OVER o, 0) AS momentum_24h,
        (close - lag(close, 6) OVER o) / nullif(lag(close, 6) OVER o, 0) * 100 AS roc_6h,
        lead(close, 60) OVER o AS future_close, (high - low) / nullif(close, 0) AS hl_spread
      FROM bars WINDOW o AS (ORDER BY timestamp)),
    f2 AS (SELECT *, avg(close) {_w(24)} AS ma_24h, sum(volume) {_w(24)} AS volume_24h,
        stddev_samp(return_1h) {_w(24)} AS volatility_24h, avg(close) {_w(12)} AS ma_12h,
        avg(close) {_w(48)} AS ma_48h, avg(close) {_w(168)} AS ma_168h,
        avg(close) {_w(24)} AS bb_middle, stddev_samp(close) {_w(24)} AS bb_std,
        stddev_samp(return_1h) {_w(12)} AS volatility_12h, stddev_samp(return_1h) {_w(48)} AS volatility_48h,
        avg(hl_spread) {_w(24)} AS hl_spread_ma24h, avg(volume) {_w(6)} AS volume_ma6h,
        avg(volume) {_w(24)} AS volume_ma24h,
        sum(close * volume) {_w(24)} / nullif(sum(volume) {_w(24)}, 0) AS vwap_24h,
        stddev_samp(volume) {_w(24)} AS volume_volatility_24h FROM f1),
    f AS (SELECT *, (close - ma_12h) / nullif(ma_12h, 0) AS price_to_ma12h,
        (close - ma_24h) / nullif(ma_24h, 0) AS price_to_ma24h,
        bb_middle + 2 * bb_std AS bb_upper, bb_middle - 2 * bb_std AS bb_lower,
        (close - (bb_middle - 2 * bb_std)) / nullif(4 * bb_std, 0) AS bb_position,
        volume_ma6h / nullif(volume_ma24h, 0) AS volume_ratio_6h_24h,
        (volume - volume_ma6h) / nullif(volume_ma6h, 0) AS volume_trend,
        (close - vwap_24h) / nullif(vwap_24h, 0) AS price_to_vwap,
        return_1h * volume AS price_volume_ratio, abs(return_1h) / (volume + 1) AS illiquidity_proxy,
        CASE WHEN future_close IS NULL THEN NULL WHEN future_close > close THEN 1 ELSE 0 END::INTEGER AS target_direction,
        (future_close - close) / nullif(close, 0) * 100 AS target_magnitude,
        hour(hour_ts)::INTEGER AS hour_of_day, (dayofweek(hour_ts) + 1)::INTEGER AS day_of_week,
        (dayofweek(hour_ts) IN (0, 6))::INTEGER AS is_weekend, (hour(hour_ts) < 8)::INTEGER AS session_asia,
        (hour(hour_ts) BETWEEN 8 AND 15)::INTEGER AS session_europe, (hour(hour_ts) >= 16)::INTEGER AS session_us
      FROM f2)
"""


def _bars(spark, sf):
    return X.bars(table(spark, sf, "events").select("ts", "value"), "ts", "value")


def _blocks(spark, sf):
    return table(spark, sf, "events").select(
        "ts", F.get_json_object("props", "$.k").cast("bigint").alias("tx_count"), F.col("value").alias("size"))


def _numbered(spark, sf):
    return S.number_rows(_bars(spark, sf), ["timestamp"])


def _features(spark, sf, names, steps, before, after=0):
    def compute(df, w):
        for step in steps:
            df = step(df, w)
        return df

    df = S.over_blocks(_numbered(spark, sf), compute, before, after)
    return rounded(df.select("timestamp", *names))


def _feature_query(name, columns, steps, before, after=0, whole=()):
    sql = f"WITH {FEATURES} SELECT {cols(*columns, plain=['timestamp', *whole])} FROM f"

    @query(name, sql)
    def run(spark, sf):
        return _features(spark, sf, [*columns, *whole], steps, before, after)

    return run


@query("ts_bars", f"WITH {BARS} SELECT {cols('open', 'high', 'low', 'close', 'volume', plain=['timestamp', 'hour_ts'])} FROM bars")
def ts_bars(spark, sf):
    return rounded(_bars(spark, sf))


_feature_query("ts_base_price", ["return_1h", "ma_24h", "volume_24h", "volatility_24h"],
               [X.base_price], X.HALO["base"])
_feature_query("ts_moving_avgs", ["ma_12h", "ma_48h", "ma_168h", "price_to_ma12h", "price_to_ma24h"],
               [X.base_price, X.moving_averages], X.HALO["moving_averages"])
_feature_query("ts_bollinger", ["bb_middle", "bb_std", "bb_upper", "bb_lower", "bb_position"],
               [X.bollinger], X.HALO["bollinger"])
_feature_query("ts_momentum", ["momentum_12h", "momentum_24h", "roc_6h"], [X.momentum], X.HALO["momentum"])
_feature_query("ts_volatility", ["volatility_12h", "volatility_48h"],
               [X.base_price, X.volatility], X.HALO["volatility"])
_feature_query("ts_hl_spread", ["hl_spread", "hl_spread_ma24h"], [X.spread], X.HALO["spread"])
_feature_query(
    "ts_microstructure",
    ["volume_ma6h", "volume_ma24h", "volume_ratio_6h_24h", "volume_trend", "vwap_24h", "price_to_vwap",
     "volume_volatility_24h", "price_volume_ratio", "illiquidity_proxy"],
    [X.base_price, X.microstructure], X.HALO["microstructure"])
_feature_query("ts_target", ["future_close", "target_magnitude"], [X.target], 0, X.HORIZON_ROWS,
               whole=["target_direction"])


@query("agg_block_hour", f"""
    WITH {BARS} SELECT hour, blocks_count, total_txs, {cols('avg_block_size', 'std_block_size')},
      max_txs_per_block, min_txs_per_block FROM hours0
""")
def agg_block_hour(spark, sf):
    return rounded(X.block_hours(_blocks(spark, sf)))


@query("ts_block_hour", f"""
    WITH {BARS} SELECT hour, blocks_count AS blocks_per_hour, total_txs, {cols('avg_block_size')} FROM hours0
""")
def ts_block_hour(spark, sf):
    return rounded(X.block_hours(_blocks(spark, sf)).select(
        "hour", F.col("blocks_count").alias("blocks_per_hour"), "total_txs", "avg_block_size"))


@query("ts_join_chain", f"""
    WITH {BARS}, errors AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS blocks_count,
        sum((props::JSON->>'$.k')::BIGINT)::BIGINT AS total_txs, avg(value) AS avg_block_size
        FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT timestamp, close, coalesce(blocks_count, 0) AS blocks_count, coalesce(total_txs, 0)::BIGINT AS total_txs,
      round(coalesce(avg_block_size, 0), {digits('avg_block_size')}) + 0.0::DOUBLE AS avg_block_size
    FROM bars LEFT JOIN errors ON hour_ts = hour
""")
def ts_join_chain(spark, sf):
    """Bars with the hourly error blocks; hours without one get zeros."""
    blocks = table(spark, sf, "events").filter("event_type = 'error'").select(
        "ts", F.get_json_object("props", "$.k").cast("bigint").alias("tx_count"), F.col("value").alias("size"))
    names = ["blocks_count", "total_txs", "avg_block_size"]
    return rounded(X.join_hours(_bars(spark, sf), X.block_hours(blocks), names).select("timestamp", "close", *names))


@query("ts_onchain", f"""
    WITH {BARS} SELECT hour, blocks_count, total_txs, max_txs_per_block, min_txs_per_block, blocks_per_hour_change,
      {cols('avg_block_size', 'std_block_size', 'tx_throughput', 'avg_block_size_6h', 'block_size_trend', 'tx_variance_ratio')}
    FROM hours
""")
def ts_onchain(spark, sf):
    return rounded(X.chain_features(_blocks(spark, sf)))


CALENDAR = ("hour_of_day", "day_of_week", "is_weekend", "session_asia", "session_europe", "session_us")


@query("ts_calendar", f"WITH {FEATURES} SELECT timestamp, {', '.join(CALENDAR)} FROM f")
def ts_calendar(spark, sf):
    return X.calendar(_bars(spark, sf), "hour_ts").select("timestamp", *CALENDAR)


PRICE_COLUMNS = [
    "open", "high", "low", "close", "volume", "return_1h", "ma_24h", "volume_24h", "volatility_24h",
    "ma_12h", "ma_48h", "ma_168h", "price_to_ma12h", "price_to_ma24h", "bb_upper", "bb_lower", "bb_position",
    "momentum_12h", "momentum_24h", "roc_6h", "volatility_12h", "volatility_48h", "hl_spread", "hl_spread_ma24h",
    "volume_ma6h", "volume_ma24h", "volume_ratio_6h_24h", "volume_trend", "vwap_24h", "price_to_vwap",
    "volume_volatility_24h", "price_volume_ratio", "illiquidity_proxy", "future_close", "target_magnitude",
]


def feature_table(spark, sf):
    return X.all_features(_numbered(spark, sf), _blocks(spark, sf))


@query("ts_all_features", f"""
    WITH {FEATURES} SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS rn, {cols(*PRICE_COLUMNS)},
      target_direction, blocks_count, total_txs, blocks_count AS blocks_per_hour,
      {cols('avg_block_size', 'tx_throughput', 'block_size_trend', 'tx_variance_ratio')}, {', '.join(CALENDAR)}
    FROM f LEFT JOIN (SELECT hour, {', '.join(f"coalesce({c}, 0) AS {c}" for c in X.CHAIN_COLUMNS)} FROM hours) ON hour_ts = hour
    WHERE future_close IS NOT NULL
""")
def ts_all_features(spark, sf):
    return rounded(feature_table(spark, sf))


@query("ts_split", f"""
    WITH {BARS}, r AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS rn, count(*) OVER () AS n FROM bars)
    SELECT timestamp, rn, CASE WHEN rn < floor(0.8 * n) THEN 'train' ELSE 'test' END AS split FROM r
""")
def ts_split(spark, sf):
    return S.chronological_split(_numbered(spark, sf)).select("timestamp", "rn", "split")


@query("doc_ema_rsi_macd", f"""
    WITH RECURSIVE {BARS},
    n AS MATERIALIZED (SELECT row_number() OVER (ORDER BY timestamp) - 1 AS rn, timestamp, close,
                              close - lag(close) OVER (ORDER BY timestamp) AS d FROM bars),
    e(rn, ema_12, ema_26) AS (
      SELECT rn, close, close FROM n WHERE rn = 0
      UNION ALL SELECT n.rn, 2/13.0::DOUBLE * close + 11/13.0::DOUBLE * ema_12,
                       2/27.0::DOUBLE * close + 25/27.0::DOUBLE * ema_26
      FROM e JOIN n ON n.rn = e.rn + 1),
    g AS (SELECT rn, d, avg(greatest(d, 0)) OVER k AS gain, avg(greatest(-d, 0)) OVER k AS loss
          FROM (SELECT * FROM n WHERE d IS NOT NULL)
          WINDOW k AS (ORDER BY rn ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
    o AS (SELECT n.timestamp, ema_12, ema_26, ema_12 - ema_26 AS macd, 100 * gain / nullif(gain + loss, 0) AS rsi_14
          FROM n JOIN e USING (rn) LEFT JOIN g USING (rn))
    SELECT {cols('ema_12', 'ema_26', 'macd', 'rsi_14', plain=['timestamp'])} FROM o
""")
def doc_ema_rsi_macd(spark, sf):
    return rounded(X.oscillators(_numbered(spark, sf)).select("timestamp", "ema_12", "ema_26", "macd", "rsi_14"))
