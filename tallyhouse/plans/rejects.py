"""Rejected lines kept beside the good ones, from one scan, with counts that the parity gate reads."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyhouse.operators import staging
from tallyhouse.operators.joins import canonicalise
from tallyhouse.operators.snapshot import latest_snapshot
from tallyhouse.sources import gold

LINES, COUNTS = "pos_lines_by_reason", "pos_line_counts"


def write_lines(spark, bronze, root, *, latest=True, lenient_time=False):
    """Write the typed lines of the newest snapshot, kept and rejected ones in folders by reason; returns counts by reason.

    Bronze is read once: lines are counted while they are written. The counts, a row for each reason that can occur, are
    stored beside the lines. Reading kept lines opens their folder only.
    """
    rows = latest_snapshot(bronze) if latest else bronze
    marked = staging.with_reject_reason(staging.type_pos(rows, lenient_time=lenient_time))
    seen = Observation(LINES)
    reasons = [staging.KEPT, *staging.REJECTS]
    counts = [F.count_if(F.col("reject_reason") == reason).alias(f"n{i}") for i, reason in enumerate(reasons)]
    gold.write_table(marked.observe(seen, *counts), root, LINES, "silver", partition_by=["reject_reason"])
    found = [(reason, seen.get[f"n{i}"]) for i, reason in enumerate(reasons)]
    gold.write_table(spark.createDataFrame(found, "reject_reason string, n_rows bigint"), root, COUNTS, "silver")
    return gold.read_table(spark, root, COUNTS, "silver")


def kept_lines(spark, root, mapping):
    """Staged POS lines, as `staging.stage_pos_lines` gives them, from what `write_lines` stored."""
    lines = gold.read_table(spark, root, LINES, "silver").where(F.col("reject_reason") == staging.KEPT).drop("reject_reason")
    return canonicalise(lines, staging.stage_mapping(mapping))


def rejected_lines(spark, root):
    """The lines staging left out, each with the first reason."""
    return gold.read_table(spark, root, LINES, "silver").where(F.col("reject_reason") != staging.KEPT)


def retention(counts):
    """One row (bronze_rows, silver_rows) for the parity gate."""
    return counts.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("bronze_rows"),
        F.coalesce(F.sum(F.when(F.col("reject_reason") == staging.KEPT, F.col("n_rows"))), F.lit(0)).cast("bigint").alias("silver_rows"),
    )
