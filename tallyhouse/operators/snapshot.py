"""Snapshot selection by arrival date."""

from pyspark.sql import functions as F

from tallyhouse.schemas import ARRIVAL


def latest_snapshot(df, col=ARRIVAL):
    """Rows of the greatest arrival date, compared as text.

    The maximum is a scalar subquery over the arrival column alone. On a partitioned table it becomes a partition filter of
    the rows themselves; where the folder names are at hand, filter by the newest of them instead (`daily.recent_bronze`),
    which looks at no older folder at all.
    """
    newest = df.select(F.max(F.col(col).cast("string"))).scalar()
    return df.where(F.col(col).cast("string") == newest)


def oldest_of_latest(left, right, col=ARRIVAL):
    """One row: the smaller of two tables' latest arrival dates, NULL if either table is empty."""
    a = left.agg(F.max(F.col(col).cast("string")).alias("_a"))
    b = right.agg(F.max(F.col(col).cast("string")).alias("_b"))
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return a.crossJoin(F.broadcast(b)).select(F.when(both, F.least("_a", "_b")).alias(col))
