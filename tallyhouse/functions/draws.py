"""Repeatable pseudo-random draws.

A draw is a hash of the seed and the row's own keys, so it does not depend on
partitioning, task retries or call order. Draws lie on a decimal grid and stay
exact.
"""

from decimal import Decimal

from pyspark.sql import functions as F


def draw(seed, label, *keys):
    """A whole number from 0 to 2^32 - 1 for the keys; `label` separates draws of one row."""
    parts = [F.lit(str(seed)), F.lit(label)]
    parts += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def uniform(low, high, scale, seed, label, *keys):
    """A decimal from `low` to `high`, both possible, in steps of 10^-scale."""
    low, high = Decimal(str(low)), Decimal(str(high))
    steps = int((high - low).scaleb(scale)) + 1
    step = F.lit(Decimal(1).scaleb(-scale))
    return (F.lit(low) + F.pmod(draw(seed, label, *keys), F.lit(steps)).cast("int") * step).cast(f"decimal(12,{scale})")
