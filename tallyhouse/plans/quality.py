"""Quality gates: each is a query whose rows are violations; no rows means it passes."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions.numbers import percent
from tallyhouse.operators.joins import lookup_join
from tallyhouse.operators.snapshot import latest_snapshot, oldest_of_latest
from tallyhouse.plans.rejects import retention
from tallyhouse.schemas import ARRIVAL

CRITICAL, WARNING, INFO = "CRITICAL", "WARNING", "INFO"


PROFILE_KEYS = (ARRIVAL, "store_id", "store_location", "product_detail")
VALUE_FIELDS = ("unit_price", "transaction_qty")


def _profile_columns(merge):
    """Line counts and the bad values of each field, from lines or merged from a finer profile."""
    columns = [F.sum("n_lines").alias("n_lines") if merge else F.count(F.lit(1)).alias("n_lines")]
    for field in VALUE_FIELDS:
        value = F.col(field).cast("double") if not merge else None
        bad = None if merge else F.when(value <= 0, value)
        columns += [
            F.sum(f"{field}_bad").alias(f"{field}_bad") if merge else F.count(bad).alias(f"{field}_bad"),
            F.min(f"{field}_min").alias(f"{field}_min") if merge else F.min(bad).alias(f"{field}_min"),
        ]
    return columns


def pos_profile(pos):
    """The newest POS snapshot counted per store and product: all that five gates need of it.

    Stored once and passed as `tables["pos_profile"]`, it saves each gate its own pass over the lines.
    """
    return latest_snapshot(pos).groupBy(*PROFILE_KEYS).agg(*_profile_columns(merge=False))


def _pos_counts(tables, *keys):
    """The newest POS snapshot counted by some of the profile's keys."""
    if "pos_profile" in tables:
        return tables["pos_profile"].groupBy(*keys).agg(*_profile_columns(merge=True))
    return latest_snapshot(tables["bronze_pos_transactions"]).groupBy(*keys).agg(*_profile_columns(merge=False))


def gate_row_count(tables, *, min_rows=300, min_stores=3):
    """Too few rows or stores in the newest POS snapshot. An empty table gives no row."""
    counts = _pos_counts(tables, ARRIVAL, "store_id").groupBy(ARRIVAL).agg(
        F.sum("n_lines").alias("row_count"), F.count("store_id").alias("store_count")
    )
    status = (
        F.when(F.col("row_count") < min_rows, f"CRITICAL: row count below threshold (min {min_rows})")
        .when(F.col("store_count") < min_stores, "CRITICAL: missing data for one or more stores")
        .otherwise("PASS")
    )
    return counts.withColumn("status", status).where("status <> 'PASS'")


# The sources that must arrive and their messages.
REQUIRED_SOURCES = (
    ("bronze_pos_transactions", "CRITICAL: POS data not found"),
    ("bronze_daily_inventory", "CRITICAL: inventory data not found"),
    ("bronze_staff_shifts", "CRITICAL: staff shifts data not found"),
)


def source_arrivals(tables, required=REQUIRED_SOURCES):
    """Row count and arrival date of the newest snapshot of each required source."""
    checks = None
    for name, message in required:
        one = latest_snapshot(tables[name]).agg(
            F.count(F.lit(1)).alias("row_count"), F.max(ARRIVAL).alias("last_ingestion")
        )
        one = one.select(
            F.lit(name).alias("source_name"),
            "row_count",
            "last_ingestion",
            F.when(F.col("row_count") == 0, message).otherwise("PASS").alias("status"),
        )
        checks = one if checks is None else checks.unionByName(one)
    return checks


def gate_sources_arrived(tables, required=REQUIRED_SOURCES):
    return source_arrivals(tables, required).where("status <> 'PASS'")


def gate_negative_values(tables):
    """Non-positive prices and quantities: how many, and the smallest.

    Both fields come from one pass; each bad field becomes a row.
    """
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(field).alias("field_name"),
                    F.col(f"{field}_bad").alias("invalid_count"),
                    F.col(f"{field}_min").alias("min_value"),
                    F.lit(f"CRITICAL: negative or zero {field} found").alias("status"),
                )
                for field in VALUE_FIELDS
            ]
        )
    ).alias("v")
    return _pos_counts(tables).select(rows).select("v.*").where("invalid_count > 0")


def gate_known_stores(tables, *, stores=tuple(s[0] for s in fixed.STORES)):
    """Store ids outside the list; a NULL id is not reported."""
    counts = _pos_counts(tables, "store_id", "store_location")
    return counts.where(~F.col("store_id").cast("int").isin(*stores)).select(
        "store_id",
        "store_location",
        F.col("n_lines").alias("transaction_count"),
        F.lit("WARNING: unknown store_id").alias("status"),
    )


def gate_cost_coverage(tables):
    """Products that need a cost but have no mapping, or whose mapped name has no cost."""
    sold = _pos_counts(tables, "product_detail").select("product_detail", F.col("n_lines").alias("transactions_today"))
    mapping = tables["product_name_mapping"].select(
        F.trim("pos_product_detail").alias("_name"),
        F.trim("canonical_product_name").alias("_canonical"),
        F.lower(F.col("cost_required").cast("string")).alias("_required"),
    )
    mapped = lookup_join(sold.withColumn("_name", F.trim("product_detail")), mapping, ["_name"])
    needed = mapped.where(F.coalesce("_required", F.lit("true")) == "true")
    costed = tables["bronze_product_costs"].select(F.trim("product_name").alias("_canonical")).distinct()
    # An unmapped product has a NULL name here, which matches no cost.
    return lookup_join(needed, costed, ["_canonical"], "left_anti").select(
        F.col("product_detail").alias("product_name"),
        "transactions_today",
        F.when(F.col("_canonical").isNull(), "WARNING: product missing mapping — gross margin may be NULL")
        .otherwise("WARNING: mapped product has no cost — gross margin will be NULL")
        .alias("status"),
    )


def gate_inventory_continuity(tables, *, tolerance=5):
    """Openings of the last day that do not continue the closings of the last day before it."""
    counts = tables["bronze_daily_inventory"].select(
        F.col("inventory_date").cast("date").alias("day"),
        F.col("store_id").cast("int").alias("store_id"),
        "ingredient_name",
        F.col("opening_stock").cast("double").alias("opening"),
        F.col("closing_stock").cast("double").alias("closing"),
    )
    days = counts.select("day")
    today = days.select(F.max("day")).scalar()
    yesterday = days.where(F.col("day") < today).select(F.max("day")).scalar()
    opened = counts.where(F.col("day") == today).select("store_id", "ingredient_name", "opening")
    closed = counts.where(F.col("day") == yesterday).select("store_id", "ingredient_name", "closing")
    gap = F.abs(F.col("opening") - F.col("closing"))
    status = (
        F.when(F.col("closing").isNull(), "WARNING: no inventory record for yesterday")
        .when(gap > tolerance, f"WARNING: inventory gap > {tolerance} units between days")
        .otherwise("PASS")
    )
    return (
        opened.join(closed, ["store_id", "ingredient_name"], "left")
        .select(
            "store_id",
            "ingredient_name",
            F.col("closing").alias("yesterday_closing"),
            F.col("opening").alias("today_opening"),
            F.abs(F.col("opening") - F.coalesce("closing", F.lit(0.0))).alias("discrepancy"),
            status.alias("status"),
        )
        .where("status <> 'PASS'")
    )


def last_day_labor(tables):
    """Labor and revenue per store on the last shift day of the snapshot both tables have."""
    shifts, pos = tables["bronze_staff_shifts"], tables["bronze_pos_transactions"]
    snapshot = oldest_of_latest(shifts, pos).scalar()
    shifts = shifts.where(F.col(ARRIVAL) == snapshot).select(
        F.col("store_id").cast("int").alias("store_id"),
        F.col("shift_date").cast("date").alias("day"),
        F.col("labor_cost_usd").cast("decimal(18,4)").alias("cost"),
    )
    last = shifts.select(F.max("day")).scalar()
    amount = F.col("transaction_qty").cast("int") * F.col("unit_price").cast("decimal(18,4)")
    labor = shifts.where(F.col("day") == last).groupBy("store_id").agg(F.sum("cost").alias("labor"))
    revenue = (
        pos.where((F.col(ARRIVAL) == snapshot) & (F.col("transaction_date").cast("date") == last))
        .groupBy(F.col("store_id").cast("int").alias("store_id"))
        .agg(F.sum(amount).alias("sales"))
    )
    return labor.join(revenue, "store_id", "left")


def gate_labor_ratio(tables, *, max_pct=60):
    """Stores without revenue on the last day, or with an extreme labor share."""
    share = percent("labor", "sales")
    status = (
        F.when(F.col("sales").isNull(), "WARNING: no revenue data for this store")
        .when(F.col("labor") * 100 > F.col("sales") * max_pct, f"INFO: labor % above {max_pct} - verify data")
        .otherwise("PASS")
    )
    # A zero revenue has no share: neither message applies.
    status = F.when(F.col("sales") == 0, "PASS").otherwise(status)
    return (
        last_day_labor(tables)
        .select(
            "store_id",
            F.col("labor").cast("decimal(20,2)").alias("labor_cost"),
            F.col("sales").cast("decimal(20,2)").alias("revenue"),
            share.alias("labor_pct"),
            status.alias("status"),
        )
        .where("status <> 'PASS'")
    )


def silver_retention(tables):
    """Rows of the newest POS snapshot before and after staging, from stored counts (`pos_line_counts`) where there are any."""
    if "pos_line_counts" in tables:
        return retention(tables["pos_line_counts"]).withColumn("pct_retained", percent("silver_rows", "bronze_rows"))
    silver = tables["stg_pos_transactions"]
    newest = tables.get("pos_profile", tables["bronze_pos_transactions"]).select(F.max(ARRIVAL)).scalar()
    before = _pos_counts(tables).select(F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("bronze_rows"))
    after = silver.where(F.col(ARRIVAL) == newest).agg(F.count(F.lit(1)).alias("silver_rows"))
    return before.crossJoin(F.broadcast(after)).withColumn("pct_retained", percent("silver_rows", "bronze_rows"))


def gate_silver_parity(tables, *, min_share="0.99"):
    """Staging kept too few rows. No Bronze rows is not a violation here."""
    lost = F.col("silver_rows") < F.col("bronze_rows") * F.lit(min_share).cast("decimal(6,4)")
    message = f"CRITICAL: silver retained less than {int(float(min_share) * 100)}% of bronze rows"
    return silver_retention(tables).where((F.col("bronze_rows") > 0) & lost).withColumn("status", F.lit(message))


@dataclass(frozen=True)
class Gate:
    level: str
    rule: Callable | None


# Gate names, severities and blocks.
GATES = {
    "01_row_count": Gate(CRITICAL, gate_row_count),
    "02_all_sources": Gate(CRITICAL, gate_sources_arrived),
    "03_negative_values": Gate(CRITICAL, gate_negative_values),
    "04_referential": Gate(WARNING, gate_known_stores),
    "05_cost_coverage": Gate(WARNING, gate_cost_coverage),
    "06_inventory": Gate(WARNING, gate_inventory_continuity),
    "07_labor_ratio": Gate(INFO, gate_labor_ratio),
    "08_silver_parity": Gate(CRITICAL, gate_silver_parity),
}
BLOCKS = {
    "completeness": ("01_row_count", "02_all_sources"),
    "integrity": ("03_negative_values", "04_referential", "05_cost_coverage"),
    "consistency": ("06_inventory", "07_labor_ratio"),
    "parity": ("08_silver_parity",),
    "all": tuple(GATES),
}
SAMPLE_ROWS = 3


class CriticalGateFailure(ValueError):
    """A CRITICAL gate has violations; `results` holds every gate's row."""

    def __init__(self, failed, results):
        super().__init__(f"{len(failed)} critical gate(s) failed: {failed}")
        self.failed = failed
        self.results = results


def expand_blocks(blocks=None, all_blocks=BLOCKS):
    """Gate names of the blocks in order, each once, and the blocks nobody knows."""
    known = [b for b in (blocks or ["all"]) if b in all_blocks]
    unknown = [b for b in (blocks or []) if b not in all_blocks]
    names = dict.fromkeys(name for block in known for name in all_blocks[block])
    if not names:
        raise ValueError("No known quality gate block to run.")
    return list(names), unknown


def gate_results(spark, tables, names, gates=GATES):
    """One row per gate: level, status and number of violations.

    A gate without a rule is an ERROR and counts as failed.
    """
    report = None
    for name in names:
        gate = gates[name]
        if gate.rule is None:
            row = spark.range(1).select(F.lit("ERROR").alias("status"), F.lit(1).cast("bigint").alias("n_failures"))
        else:
            row = gate.rule(tables).agg(F.count(F.lit(1)).alias("n_failures"))
            row = row.select(F.when(F.col("n_failures") == 0, "PASS").otherwise("FAIL").alias("status"), "n_failures")
        row = row.select(F.lit(name).alias("gate"), F.lit(gate.level).alias("level"), "status", "n_failures")
        report = row if report is None else report.unionByName(row)
    return report


def failure_sample(violations, rows=SAMPLE_ROWS):
    """The first violations as JSON text, for the report."""
    text = violations.select(F.to_json(F.struct(*violations.columns)).alias("row"))
    return [r.row for r in text.orderBy("row").limit(rows).collect()]


def run_gates(spark, tables, blocks=None, *, run_date, gates=GATES, store=None, sample_rows=SAMPLE_ROWS):
    """Run the gates of the blocks, store the results, then raise if a CRITICAL one failed.

    All gates are counted in one job. Only failing gates are evaluated again,
    for a sample of `sample_rows` rows; the summary holds all their violations as
    DataFrames. `store(results, failures)` gets the one-row-per-gate
    table and the complete violations of each failing gate as DataFrames, before
    the check; storing is best effort and its error becomes a note.
    """
    names, unknown = expand_blocks(blocks)
    rows = gate_results(spark, tables, names, gates).collect()
    failures = {r.gate: gates[r.gate].rule(tables) for r in rows if r.status == "FAIL"}
    samples = {name: failure_sample(found, sample_rows) for name, found in failures.items()}
    samples |= {r.gate: ["rule not found"] for r in rows if r.status == "ERROR"}
    schema = "gate string, level string, status string, n_failures bigint, sample array<string>"
    results = spark.createDataFrame([(*r, samples.get(r.gate, [])) for r in rows], schema)
    results = results.withColumn("run_date", F.lit(run_date))
    notes = [f"unknown block skipped: {block}" for block in unknown]
    if store is not None:
        try:
            store(results, failures)
        except Exception as error:
            notes.append(f"results not stored: {error}")
    failed = {
        level: [r.gate for r in rows if r.status != "PASS" and r.level == level] for level in (CRITICAL, WARNING, INFO)
    }
    if failed[CRITICAL]:
        raise CriticalGateFailure(failed[CRITICAL], results)
    summary = {
        "run_date": run_date,
        "passed": [r.gate for r in rows if r.status == "PASS"],
        "warnings": failed[WARNING],
        "info": failed[INFO],
        "failed_critical": [],
        "violations": failures,
        "notes": notes,
    }
    return results, summary
