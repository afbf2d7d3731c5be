"""Staging: typed, trimmed and filtered views of the Bronze datasets.

Each function takes the Bronze table and returns the staged one. `latest=False`
keeps all snapshots.
"""

from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions.text import hour_of
from tallyhouse.operators.joins import canonicalise
from tallyhouse.operators.ordered import number_lines
from tallyhouse.operators.snapshot import latest_snapshot

# The order that numbers the lines of a transaction.
LINE_ORDER = ["product_id", "product_name_raw", "transaction_time", "unit_price", "transaction_qty"]

STAGED_POS = [
    "transaction_id",
    "transaction_line_number",
    "store_id",
    "product_id",
    "transaction_date",
    "transaction_time",
    "transaction_hour",
    "transaction_qty",
    "unit_price",
    "gross_revenue",
    "store_location",
    "product_category",
    "product_type",
    "product_name_raw",
    "product_name",
    "size_code",
    "cost_required",
    "recipe_required",
    "product_group",
    "ingestion_date",
]


def cast_columns(columns, arrival=True):
    """Select list for a dataset: cast every column, trim the text ones, arrival date as text."""
    out = []
    for name, kind in columns.items():
        column = F.trim(F.col(name)) if kind == "string" else F.col(name).cast(kind)
        out.append(column.alias(name))
    if arrival:
        out.append(F.col(schemas.ARRIVAL).cast("string").alias(schemas.ARRIVAL))
    return out


def stage_mapping(seed):
    """The name mapping with trimmed text, blank size codes as NULL and boolean flags."""
    typed = seed.select(*cast_columns(schemas.MAPPING, arrival=False))
    return typed.withColumn("size_code", F.nullif("size_code", F.lit("")))


def type_pos(bronze, *, lenient_time=False):
    """Cast POS lines and derive the hour and the revenue."""
    kinds = schemas.POS
    quantity = F.col("transaction_qty").cast(kinds["transaction_qty"])
    price = F.col("unit_price").cast(kinds["unit_price"])
    return bronze.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col("store_id").cast("int").alias("store_id"),
        F.col("product_id").cast("int").alias("product_id"),
        F.col("transaction_date").cast("date").alias("transaction_date"),
        F.col("transaction_time").cast("string").alias("transaction_time"),
        hour_of(F.col("transaction_time"), lenient_time).alias("transaction_hour"),
        quantity.alias("transaction_qty"),
        price.alias("unit_price"),
        (quantity * price).cast("decimal(20,2)").alias("gross_revenue"),
        F.trim("store_location").alias("store_location"),
        F.trim("product_category").alias("product_category"),
        F.trim("product_type").alias("product_type"),
        F.trim("product_detail").alias("product_name_raw"),
        F.col(schemas.ARRIVAL).cast("string").alias(schemas.ARRIVAL),
    )


def reject_nulls(bronze):
    """Drop POS lines without id, date, quantity or price."""
    return bronze.dropna(subset=["transaction_id", "transaction_date", "transaction_qty", "unit_price"])


def reject_out_of_range(typed):
    """Drop POS lines whose quantity or price is not positive."""
    return typed.where((F.col("transaction_qty") > 0) & (F.col("unit_price") > 0))


# Reasons a line is rejected for, in the order they are looked at.
KEPT = "kept"
REJECTS = {
    "no transaction id": "transaction_id is null",
    "no date": "transaction_date is null",
    "no quantity": "transaction_qty is null",
    "no price": "unit_price is null",
    "quantity not positive": "not transaction_qty > 0",
    "price not positive": "not unit_price > 0",
}


def with_reject_reason(typed):
    """Typed POS lines with the first reason that rejects them, or KEPT: just the lines that staging keeps."""
    reason = F.lit(KEPT)
    for name, broken in reversed(REJECTS.items()):
        reason = F.when(F.expr(broken), name).otherwise(reason)
    return typed.withColumn("reject_reason", reason)


def stage_pos_lines(bronze, mapping, *, latest=True, lenient_time=False):
    """Staged POS lines without their line number.

    Aggregates do not need the number; leaving it out saves them the shuffle.
    """
    bronze = latest_snapshot(bronze) if latest else bronze
    typed = reject_out_of_range(type_pos(reject_nulls(bronze), lenient_time=lenient_time))
    return canonicalise(typed, stage_mapping(mapping))


def number_pos(lines, **options):
    """Staged POS lines with their number inside the transaction."""
    return number_lines(lines, ["transaction_id"], LINE_ORDER, **options).select(*STAGED_POS)


def stage_pos(bronze, mapping, *, latest=True, lenient_time=False):
    """Complete staged POS table, one row per product line of a transaction."""
    return number_pos(stage_pos_lines(bronze, mapping, latest=latest, lenient_time=lenient_time))


def stage_costs(bronze, *, latest=True):
    """Product costs: positive cost and price, cost not above price."""
    bronze = latest_snapshot(bronze) if latest else bronze
    rows = bronze.select(*cast_columns(schemas.COSTS))
    cost, price = F.col("unit_cost"), F.col("unit_price_std")
    return rows.where((cost > 0) & (price > 0) & (cost <= price))


def stage_bom(bronze, *, latest=True):
    """Recipe rows with a positive quantity."""
    bronze = latest_snapshot(bronze) if latest else bronze
    return bronze.select(*cast_columns(schemas.BOM)).where(F.col("qty_required_per_unit") > 0)


def stage_inventory(bronze, *, latest=True):
    """Daily counts with a date and a closing stock that is not negative."""
    bronze = latest_snapshot(bronze) if latest else bronze
    rows = bronze.select(*cast_columns(schemas.INVENTORY))
    return rows.where(F.col("inventory_date").isNotNull() & (F.col("closing_stock") >= 0))


def stage_shifts(bronze, *, latest=True):
    """Shifts with positive labor cost and at least one employee."""
    bronze = latest_snapshot(bronze) if latest else bronze
    rows = bronze.select(*cast_columns(schemas.SHIFTS))
    return rows.where((F.col("labor_cost_usd") > 0) & (F.col("employees_on_shift") > 0))


def stage_promotions(bronze, *, latest=False):
    """Promotions; every load is kept unless `latest` asks for the newest snapshot."""
    bronze = latest_snapshot(bronze) if latest else bronze
    return bronze.select(*cast_columns(schemas.PROMOTIONS, arrival=False))
