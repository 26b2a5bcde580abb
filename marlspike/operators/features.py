"""Price, chain and calendar features of an ordered bar series.

Every function takes the rows of a block and the block's window (see
``series.over_blocks``). ``N`` in a name means the current row and the ``N``
rows before it. ``HALO`` tells how many earlier rows a feature group needs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marlspike.functions.maths import relative_change
from marlspike.operators import series as S

# Rows ahead of the prediction target, and rows a feature group looks back.
HORIZON_ROWS = 60
HALO = {
    "base": 25, "moving_averages": 168, "bollinger": 24, "momentum": 24, "volatility": 49,
    "spread": 24, "microstructure": 24, "chain": 6,
}
CHAIN_COLUMNS = (
    "blocks_count", "total_txs", "avg_block_size", "tx_throughput", "block_size_trend", "tx_variance_ratio",
)
INTERMEDIATES = ("hour_ts", "hour", "bb_std", "bb_middle")


def _span(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-n, 0)


def _lag_change(name: str, k: int, w: WindowSpec) -> Column:
    return relative_change(F.col(name), F.lag(name, k).over(w))


def bars(events: DataFrame, ts: str, value: str) -> DataFrame:
    """Hourly open, high, low, close and volume of a value stream; of equal times the smallest value opens, the largest closes."""
    at = F.struct(ts, value)
    return (
        events.groupBy(F.date_trunc("hour", ts).alias("_hour"))
        .agg(
            F.min_by(value, at).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"),
            F.max_by(value, at).alias("close"), F.sum(value).alias("volume"),
        )
        .select(F.unix_seconds("_hour").alias("timestamp"),
                F.col("_hour").cast("timestamp_ntz").alias("hour_ts"),
                "open", "high", "low", "close", "volume")
    )


def base_price(df: DataFrame, w: WindowSpec) -> DataFrame:
    return (
        df.withColumn("return_1h", _lag_change("close", 1, w))
        .withColumn("ma_24h", F.avg("close").over(_span(w, 24)))
        .withColumn("volume_24h", F.sum("volume").over(_span(w, 24)))
        .withColumn("volatility_24h", F.stddev_samp("return_1h").over(_span(w, 24)))
    )


def moving_averages(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Needs ``ma_24h``."""
    close = F.col("close")
    return (
        df.withColumns({f"ma_{n}h": F.avg("close").over(_span(w, n)) for n in (12, 48, 168)})
        .withColumn("price_to_ma12h", relative_change(close, F.col("ma_12h")))
        .withColumn("price_to_ma24h", relative_change(close, F.col("ma_24h")))
    )


def bollinger(df: DataFrame, w: WindowSpec) -> DataFrame:
    day = _span(w, 24)
    mid, std = F.col("bb_middle"), F.col("bb_std")
    return (
        df.withColumn("bb_middle", F.avg("close").over(day))
        .withColumn("bb_std", F.stddev_samp("close").over(day))
        .withColumn("bb_upper", mid + 2 * std)
        .withColumn("bb_lower", mid - 2 * std)
        .withColumn("bb_position", F.try_divide(F.col("close") - F.col("bb_lower"), F.col("bb_upper") - F.col("bb_lower")))
    )


def momentum(df: DataFrame, w: WindowSpec) -> DataFrame:
    return df.withColumns({
        "momentum_12h": _lag_change("close", 12, w),
        "momentum_24h": _lag_change("close", 24, w),
        "roc_6h": _lag_change("close", 6, w) * 100,
    })


def volatility(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Needs ``return_1h``."""
    return df.withColumns({
        f"volatility_{n}h": F.stddev_samp("return_1h").over(_span(w, n)) for n in (12, 48)
    })


def spread(df: DataFrame, w: WindowSpec) -> DataFrame:
    return df.withColumn(
        "hl_spread", F.try_divide(F.col("high") - F.col("low"), F.col("close"))
    ).withColumn("hl_spread_ma24h", F.avg("hl_spread").over(_span(w, 24)))


def microstructure(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Needs ``return_1h``."""
    close, volume, day = F.col("close"), F.col("volume"), _span(w, 24)
    return (
        df.withColumn("volume_ma6h", F.avg("volume").over(_span(w, 6)))
        .withColumn("volume_ma24h", F.avg("volume").over(day))
        .withColumn("volume_ratio_6h_24h", F.try_divide("volume_ma6h", F.col("volume_ma24h")))
        .withColumn("volume_trend", relative_change(volume, F.col("volume_ma6h")))
        .withColumn("vwap_24h", F.try_divide(F.sum(close * volume).over(day), F.sum("volume").over(day)))
        .withColumn("price_to_vwap", relative_change(close, F.col("vwap_24h")))
        .withColumn("volume_volatility_24h", F.stddev_samp("volume").over(day))
        .withColumn("price_volume_ratio", F.col("return_1h") * volume)
        .withColumn("illiquidity_proxy", F.abs("return_1h") / (volume + 1))
    )


def target(df: DataFrame, w: WindowSpec, horizon: int = HORIZON_ROWS) -> DataFrame:
    """Future close, direction and percentage move; null where the future is missing."""
    future, close = F.col("future_close"), F.col("close")
    return (
        df.withColumn("future_close", F.lead("close", horizon).over(w))
        .withColumn("target_direction", F.when(future.isNotNull(), (future > close).cast("int")))
        .withColumn("target_magnitude", relative_change(future, close) * 100)
    )


def calendar(df: DataFrame, moment: str) -> DataFrame:
    hour, weekday = F.col("hour_of_day"), F.col("day_of_week")
    return (
        df.withColumn("hour_of_day", F.hour(moment))
        .withColumn("day_of_week", F.dayofweek(moment))
        .withColumn("is_weekend", weekday.isin(1, 7).cast("int"))
        .withColumn("session_asia", (hour < 8).cast("int"))
        .withColumn("session_europe", hour.between(8, 15).cast("int"))
        .withColumn("session_us", (hour >= 16).cast("int"))
    )


# --- chain side ------------------------------------------------------------

def block_hours(blocks: DataFrame, ts: str = "ts") -> DataFrame:
    """Count, sum, average, deviation and extremes of blocks per hour."""
    return blocks.groupBy(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")).agg(
        F.count(F.lit(1)).alias("blocks_count"),
        F.sum("tx_count").alias("total_txs"),
        F.avg("size").alias("avg_block_size"),
        F.stddev_samp("size").alias("std_block_size"),
        F.max("tx_count").alias("max_txs_per_block"),
        F.min("tx_count").alias("min_txs_per_block"),
    )


def chain(hours: DataFrame, w: WindowSpec) -> DataFrame:
    return (
        hours.withColumn("blocks_per_hour_change", F.col("blocks_count") - F.lag("blocks_count", 1).over(w))
        .withColumn("tx_throughput", F.try_divide("total_txs", F.col("blocks_count")))
        .withColumn("avg_block_size_6h", F.avg("avg_block_size").over(_span(w, 6)))
        .withColumn("block_size_trend", relative_change(F.col("avg_block_size"), F.col("avg_block_size_6h")))
        .withColumn("tx_variance_ratio",
                    F.try_divide(F.col("max_txs_per_block") - F.col("min_txs_per_block"), F.col("total_txs")))
    )


def chain_features(blocks: DataFrame, ts: str = "ts", block: int = S.BLOCK_ROWS) -> DataFrame:
    return S.ordered_window(block_hours(blocks, ts), ["hour"], chain, HALO["chain"], block=block).drop("rn")


def join_hours(prices: DataFrame, hours: DataFrame, columns) -> DataFrame:
    """Left join on the hour; hours without blocks get zeros."""
    side = hours.select("hour", *columns)
    return prices.join(side, F.col("hour_ts") == F.col("hour"), "left").fillna(0, subset=list(columns))


# --- recursive averages ----------------------------------------------------

def ema_reach(span: int) -> int:
    """Rows after which an exponential weight is below double precision."""
    return math.ceil(math.log(1e-16) / math.log(1 - 2 / (span + 1)))


def ema_block(span: int) -> int:
    """Largest block whose scaled weights stay within double range."""
    return min(2048, int(600 / -math.log(1 - 2 / (span + 1))) - ema_reach(span))


def ema(value: str, span: int, w: WindowSpec, block: int, rn: str = "rn") -> Column:
    """ema₀ = x₀, emaₜ = a·xₜ + (1−a)·emaₜ₋₁ with a = 2/(span+1), as one running sum.

    Terms are scaled by the decay relative to the block's start, summed, and
    scaled back. Rows before the halo would weigh less than double precision.
    """
    a = 2 / (span + 1)
    e = (F.col(rn) - F.col("_block") * block).cast("double")
    weight = F.when(F.col(rn) == 0, 1.0).otherwise(a)
    scaled = weight * F.col(value) * F.pow(F.lit(1 - a), -e)
    return F.sum(scaled).over(w.rowsBetween(S.Window.unboundedPreceding, 0)) * F.pow(F.lit(1 - a), e)


def oscillators(numbered: DataFrame, block: int | None = None, rsi_rows: int = 14) -> DataFrame:
    """EMA 12 and 26, MACD (their difference) and the averaged-window RSI."""
    size = block or min(ema_block(12), ema_block(26))

    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        change = F.col("close") - F.lag("close", 1).over(w)
        recent = w.rowsBetween(-(rsi_rows - 1), 0)
        gain, loss = F.col("_gain"), F.col("_loss")
        return (
            df.withColumn("_change", change)
            .withColumn("_gain", F.avg(F.greatest("_change", F.lit(0.0))).over(recent))
            .withColumn("_loss", F.avg(F.greatest(-F.col("_change"), F.lit(0.0))).over(recent))
            .withColumn("rsi_14", F.when(F.col("_change").isNotNull(), F.try_divide(100 * gain, gain + loss)))
            .withColumn("ema_12", ema("close", 12, w, size))
            .withColumn("ema_26", ema("close", 26, w, size))
            .withColumn("macd", F.col("ema_12") - F.col("ema_26"))
            .drop("_change", "_gain", "_loss")
        )

    return S.over_blocks(numbered, compute, before=max(ema_reach(26), rsi_rows), block=size)


# --- full table ------------------------------------------------------------

def all_features(numbered: DataFrame, blocks: DataFrame, horizon: int = HORIZON_ROWS,
                 block: int = S.BLOCK_ROWS) -> DataFrame:
    """Every feature column and the target; all price windows share one shuffle."""

    def compute(df: DataFrame, w: WindowSpec) -> DataFrame:
        for step in (base_price, moving_averages, bollinger, momentum, volatility, spread, microstructure):
            df = step(df, w)
        return target(df, w, horizon)

    price = S.over_blocks(numbered, compute, before=HALO["moving_averages"] + 1, after=horizon, block=block)
    price = price.filter(F.col("future_close").isNotNull())
    joined = join_hours(price, chain_features(blocks, block=block), CHAIN_COLUMNS)
    full = calendar(joined, "hour_ts").withColumn("blocks_per_hour", F.col("blocks_count"))
    return full.drop(*INTERMEDIATES)
