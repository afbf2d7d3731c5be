"""Validity ranges as an index of disjoint intervals, for products with hundreds of versions.

A plain validity join compares each line with every version of its product. Here the versions of a product are first swept
into elementary intervals, in each of which the same versions are in force. The intervals are filed under bins of days, and
lines look them up by product and bin: an equality join that meets the few intervals of one bin, and spreads a product that
holds a large part of all lines over as many keys as the calendar has bins.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

BIN_DAYS = 8


def _bin(day, bin_days):
    return F.floor(F.unix_date(day) / F.lit(bin_days)).cast("int")


def _in_force(table, keys, valid_from, valid_to):
    """Versions that are ever in force: keys and both bounds set, bounds in order."""
    first, last = F.col(valid_from).cast("date"), F.col(valid_to).cast("date")
    return table.withColumns({"_from": first, "_to": last}).dropna(subset=[*keys, "_from", "_to"]).where("_from <= _to")


def elementary_intervals(table, keys, *, valid_from="valid_from", valid_to="valid_to"):
    """Disjoint intervals (keys, seg_from, seg_to, n_versions) that cover exactly the days some version is in force.

    Both bounds belong to an interval. No version starts or ends within one. Versions without bounds, or that end before
    they start, are never in force.
    """
    versions = _in_force(table, keys, valid_from, valid_to)
    ends = F.explode(
        F.array(
            F.struct(F.col("_from").alias("day"), F.lit(1).alias("change")),
            F.struct(F.date_add("_to", 1).alias("day"), F.lit(-1).alias("change")),
        )
    )
    bounds = versions.select(*keys, ends.alias("_e")).groupBy(*keys, F.col("_e.day").alias("seg_from")).agg(
        F.sum("_e.change").alias("_change")
    )
    order = Window.partitionBy(*keys).orderBy("seg_from")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    return (
        bounds.withColumns({
            "seg_to": F.date_sub(F.lead("seg_from").over(order), 1),
            "n_versions": F.sum("_change").over(running).cast("bigint"),
        })
        .where("n_versions > 0")
        .select(*keys, "seg_from", "seg_to", "n_versions")
    )


def overlaps(table, keys, *, valid_from="valid_from", valid_to="valid_to"):
    """The elementary intervals in which more than one version is in force."""
    return elementary_intervals(table, keys, valid_from=valid_from, valid_to=valid_to).where("n_versions > 1")


def _binned(rows, first, last, bounds, bin_days):
    """Rows filed under every bin between two day columns, as far as these lie within the bounds (one row: lo, hi)."""
    low, high = F.greatest(first, F.col("_lo")), F.least(last, F.col("_hi"))
    kept = rows.crossJoin(F.broadcast(bounds)).where(low <= high)
    return kept.withColumn("_bin", F.explode(F.sequence(_bin(low, bin_days), _bin(high, bin_days)))).drop("_lo", "_hi")


def versions_by_interval(table, keys, *, valid_from="valid_from", valid_to="valid_to", latest=False, bounds=None, bin_days=BIN_DAYS):
    """Elementary intervals with the versions in force: keys, seg_from, seg_to, then the other columns of the table.

    All versions of an interval give a row each; with `latest` only the one that starts last does (then the one that ends
    last, then the greatest of the other columns). `bounds` is a one-row table (_lo, _hi) of the days of interest.
    """
    others = [c for c in table.columns if c not in keys]
    versions = _in_force(table, keys, valid_from, valid_to)
    segments = elementary_intervals(table, keys, valid_from=valid_from, valid_to=valid_to).drop("n_versions")
    if bounds is None:
        bounds = versions.agg(F.min("_from").alias("_lo"), F.max("_to").alias("_hi"))
    segments = segments.crossJoin(F.broadcast(bounds)).where((F.col("seg_to") >= F.col("_lo")) & (F.col("seg_from") <= F.col("_hi")))
    # An interval meets its versions in the bin of its first day, which all of them cover.
    first = F.greatest("seg_from", F.col("_lo"))
    segments = segments.withColumn("_bin", _bin(first, bin_days)).drop("_lo", "_hi")
    filed = _binned(versions, F.col("_from"), F.col("_to"), bounds, bin_days)
    found = segments.join(filed, [*keys, "_bin"]).where("_from <= seg_from and _to >= seg_to")
    if latest:
        order = F.struct("_from", "_to", *[c for c in others if c not in (valid_from, valid_to)], valid_from, valid_to)
        found = found.groupBy(*keys, "seg_from", "seg_to").agg(F.max(order).alias("_v")).select(
            *keys, "seg_from", "seg_to", *[F.col(f"_v.{c}").alias(c) for c in others]
        )
    return found.select(*keys, "seg_from", "seg_to", *others)


def join_valid_indexed(lines, costs, *, key="product_name", date_col="transaction_date", valid_from="valid_from",
                       valid_to="valid_to", latest=False, bin_days=BIN_DAYS):
    """Left join lines to the versions in force on their day, by way of the interval index.

    Gives what `joins.join_valid` gives: overlapping versions multiply a line. With `latest` a line keeps the version that
    starts last, so that the number of lines never changes. Lines without a key or day stay, without a version.
    """
    day = F.col(date_col).cast("date")
    bounds = lines.agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    index = versions_by_interval(
        costs, [key], valid_from=valid_from, valid_to=valid_to, latest=latest, bounds=bounds, bin_days=bin_days
    )
    index = _binned(index, F.col("seg_from"), F.col("seg_to"), bounds, bin_days).withColumnsRenamed({key: "_key", "_bin": "_own"})
    match = [F.col(key) == F.col("_key"), F.col("_bin") == F.col("_own"), day.between(F.col("seg_from"), F.col("seg_to"))]
    found = lines.withColumn("_bin", _bin(day, bin_days)).join(index, reduce(and_, match), "left")
    return found.drop("_bin", "_key", "_own", "seg_from", "seg_to")
