"""Timestamps that arrive as text, epoch seconds or epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The largest epoch read as seconds, and the accepted text formats.
MAX_EPOCH_SECONDS = 4102444800
TEXT_FORMATS = (
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
)


def epoch_seconds(raw: Column) -> Column:
    """Epoch seconds of a text column; junk becomes null.

    Numbers are tried first and values beyond ``MAX_EPOCH_SECONDS`` are read as
    milliseconds; text is then tried against each format in turn.
    """
    text = F.trim(raw.cast("string"))
    number = text.try_cast("double").cast("bigint")
    numeric = F.when(number > MAX_EPOCH_SECONDS, F.floor(number / 1000)).otherwise(number)
    parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in TEXT_FORMATS])
    return F.coalesce(numeric, F.unix_seconds(parsed))
