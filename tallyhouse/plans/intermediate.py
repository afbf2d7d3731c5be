"""Intermediate models between staging and the facts."""

from pyspark.sql import functions as F

from tallyhouse.functions.numbers import money, percent
from tallyhouse.operators.joins import explode_bom, join_valid

SALES_COLUMNS = [
    "transaction_id",
    "transaction_line_number",
    "transaction_date",
    "transaction_hour",
    "store_id",
    "store_location",
    "product_id",
    "product_name_raw",
    "product_name",
    "product_category",
    "product_type",
    "product_group",
    "cost_required",
    "recipe_required",
    "transaction_qty",
    "unit_price",
    "gross_revenue",
    "unit_cost",
    "cogs_pct",
    "cogs_amount",
    "gross_profit",
    "gross_margin_pct",
]


def sales_with_costs(lines, costs):
    """Lines with the cost in force on their day, cost of goods, profit and margin.

    Without a cost the three measures are NULL; the margin also at zero revenue.
    """
    valid = costs.select("product_name", "unit_cost", "cogs_pct", "valid_from", "valid_to")
    cost = F.col("transaction_qty") * F.col("unit_cost")
    profit = F.col("gross_revenue") - cost
    priced = join_valid(lines, valid).withColumns(
        {
            "cogs_amount": money(cost),
            "gross_profit": money(profit),
            "gross_margin_pct": percent(profit, "gross_revenue"),
        }
    )
    return priced.select(*[c for c in SALES_COLUMNS if c in priced.columns])


def units_by_product(lines):
    """Units sold per day, store and product that has a recipe."""
    return (
        lines.where("recipe_required")
        .groupBy("transaction_date", "store_id", "product_name")
        .agg(F.sum("transaction_qty").alias("total_qty_sold"))
    )


def theoretical_consumption(lines, bom):
    """Ingredient use the recipes imply, per day, store and ingredient.

    Sales are summed before the recipe join, so the join multiplies daily totals, not lines.
    """
    recipe = bom.select(
        "product_name", "ingredient_name", "unit_of_measure", "ingredient_cost_per_unit", "qty_required_per_unit"
    )
    used = F.col("total_qty_sold") * F.col("qty_required_per_unit")
    return (
        explode_bom(units_by_product(lines), recipe)
        .groupBy("transaction_date", "store_id", "ingredient_name", "unit_of_measure", "ingredient_cost_per_unit")
        .agg(money(F.sum(used), 4, 24).alias("theoretical_consumption"))
    )


def labor_totals(shifts):
    """Labor cost, hours and employee shifts per day and store."""
    return shifts.groupBy("shift_date", "store_id").agg(
        F.sum("labor_cost_usd").cast("decimal(20,2)").alias("total_labor_cost"),
        F.sum("total_hours").cast("decimal(16,1)").alias("total_hours_worked"),
        F.sum("employees_on_shift").alias("total_employee_shifts"),
    )


def daily_revenue(lines):
    """Revenue per day and store."""
    return lines.groupBy("transaction_date", "store_id").agg(
        F.sum("gross_revenue").cast("decimal(20,2)").alias("daily_revenue")
    )


def labor_by_day(shifts, lines):
    """Labor totals beside the revenue of the same day and store; days without shifts are absent."""
    revenue = daily_revenue(lines).withColumnRenamed("transaction_date", "shift_date")
    return (
        labor_totals(shifts)
        .join(revenue, ["shift_date", "store_id"], "left")
        .withColumn("labor_cost_pct", percent("total_labor_cost", "daily_revenue"))
    )
