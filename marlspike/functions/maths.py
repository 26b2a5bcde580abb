"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOGIT_CLIP = 30.0


def sigmoid(x: Column) -> Column:
    """Logistic function with a clipped argument, so ``exp`` cannot overflow."""
    clipped = F.greatest(F.least(x, F.lit(LOGIT_CLIP)), F.lit(-LOGIT_CLIP))
    return 1 / (1 + F.exp(-clipped))


def relative_change(new: Column, old: Column) -> Column:
    """(new - old) / old, null when ``old`` is zero or null."""
    return F.try_divide(new - old, old)
