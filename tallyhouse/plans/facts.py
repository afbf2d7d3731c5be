"""Fact tables. Dimension keys are looked up on natural keys; a missing member leaves NULL."""

from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions.keys import surrogate_key
from tallyhouse.functions.numbers import money, percent, ratio
from tallyhouse.operators.joins import lookup_keys
from tallyhouse.operators.ordered import trailing_avg


def _date_and_store(day, dim_date, dim_store):
    return [
        (dim_date, {day: "full_date"}, "date_key"),
        (dim_store, {"store_id": "store_id"}, "store_key"),
    ]


SALES_FACT = [
    "sales_key",
    "transaction_id",
    "transaction_line_number",
    "date_key",
    "store_key",
    "product_key",
    "transaction_qty",
    "unit_price",
    "gross_revenue",
    "unit_cost",
    "cogs_amount",
    "gross_profit",
    "gross_margin_pct",
    "transaction_date",
    "transaction_hour",
    "cost_required",
    "recipe_required",
    "product_name_raw",
    "product_name",
]


def build_fct_sales(sales, dim_date, dim_store, dim_product):
    """One row per product line of a transaction.

    From sales without line numbers the fact has no `sales_key` either: enough
    for every measure, and it saves numbering the lines.
    """
    lookups = _date_and_store("transaction_date", dim_date, dim_store)
    lookups.append((dim_product, {"product_name": "product_name"}, "product_key"))
    fact = lookup_keys(sales, lookups)
    if "transaction_line_number" in sales.columns:
        fact = fact.withColumn("sales_key", surrogate_key("transaction_id", "transaction_line_number"))
    return fact.select(*[c for c in SALES_FACT if c in fact.columns])


def waste_measures(theoretical, inventory):
    """Theoretical against counted use per day, store and ingredient; days without sales are absent."""
    counted = inventory.select(
        F.col("inventory_date").alias("transaction_date"), "store_id", "ingredient_name", "actual_consumed"
    )
    gap = F.col("actual_consumed") - F.col("theoretical_consumption")
    return theoretical.join(counted, ["transaction_date", "store_id", "ingredient_name"], "left").withColumns(
        {
            "waste_qty": money(gap, 4, 24),
            "waste_amount_usd": money(gap * F.col("ingredient_cost_per_unit"), 4, 24),
            "waste_rate_pct": percent(gap, "theoretical_consumption"),
        }
    )


def build_fct_waste(theoretical, inventory, dim_date, dim_store, dim_ingredient):
    """Waste per ingredient, store and day."""
    lookups = _date_and_store("transaction_date", dim_date, dim_store)
    lookups.append((dim_ingredient, {"ingredient_name": "ingredient_name"}, "ingredient_key"))
    return lookup_keys(waste_measures(theoretical, inventory), lookups).select(
        surrogate_key("transaction_date", "store_id", "ingredient_name").alias("waste_key"),
        "date_key",
        "store_key",
        "ingredient_key",
        "ingredient_name",
        "unit_of_measure",
        "theoretical_consumption",
        "actual_consumed",
        "waste_qty",
        "waste_amount_usd",
        "waste_rate_pct",
        "transaction_date",
        "store_id",
    )


def labor_status(pct="labor_cost_pct"):
    """Class of a labor percentage; NULL counts as on target."""
    return (
        F.when(F.col(pct) > fixed.LABOR_OVER, "OVER TARGET")
        .when(F.col(pct) > fixed.LABOR_WATCH, "WATCH")
        .otherwise("ON TARGET")
    )


def build_fct_labor(labor, dim_date, dim_store):
    """Labor per store and day."""
    return lookup_keys(labor, _date_and_store("shift_date", dim_date, dim_store)).select(
        surrogate_key("shift_date", "store_id").alias("labor_key"),
        "date_key",
        "store_key",
        "total_labor_cost",
        "total_hours_worked",
        "total_employee_shifts",
        "daily_revenue",
        "labor_cost_pct",
        labor_status().alias("labor_status"),
        "shift_date",
        "store_id",
    )


def stock_risk(days):
    """Class of the remaining days before rounding; NULL counts as low."""
    return (
        F.when(days < fixed.STOCK_HIGH_RISK, "HIGH").when(days < fixed.STOCK_MEDIUM_RISK, "MEDIUM").otherwise("LOW")
    )


def inventory_coverage(inventory):
    """Days of stock left against the mean use of the last seven records, and the risk class."""
    series = trailing_avg(
        inventory, ["store_id", "ingredient_name"], "inventory_date", "actual_consumed", fixed.TRAILING_RECORDS
    )
    # closing / (sum / count), with a single division
    days = ratio(F.col("closing_stock") * F.col("trailing_count"), "trailing_sum")
    return series.withColumns(
        {"days_of_inventory_remaining": money(days, 1, 18), "stockout_risk_flag": stock_risk(days)}
    )


def build_fct_inventory_snapshot(inventory, dim_date, dim_store):
    """Stock per ingredient, store and day with its coverage."""
    covered = inventory_coverage(inventory)
    return lookup_keys(covered, _date_and_store("inventory_date", dim_date, dim_store)).select(
        surrogate_key("inventory_date", "store_id", "ingredient_name").alias("snapshot_key"),
        "date_key",
        "store_key",
        "ingredient_name",
        "opening_stock",
        "closing_stock",
        "units_received",
        "days_of_inventory_remaining",
        "stockout_risk_flag",
        F.col("inventory_date").alias("snapshot_date"),
        "store_id",
    )
