"""Dashboard measures over the Gold tables.

Shares are fractions (0.25, not 25) with six places; an empty or zero
denominator shows as 0.
"""

from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions.numbers import money, rate_or_zero, rounded_ratio
from tallyhouse.operators.joins import lookup_join
from tallyhouse.operators.ordered import period_growth, rank_by
from tallyhouse.plans.reports import star

STORE_FACTS = ("fct_sales", "fct_waste", "fct_labor", "fct_inventory_snapshot")


def slice_gold(gold, *, stores=None, categories=None, date_from=None, date_to=None):
    """Gold tables as the slicers show them.

    Store names and the date range filter every fact, product categories the
    sales. Facts are semi-joined to the filtered dimensions.
    """
    sliced = dict(gold)
    if stores is not None:
        sliced["dim_store"] = gold["dim_store"].where(F.col("store_name").isin(*stores))
    if date_from is not None or date_to is not None:
        first = F.lit(date_from).cast("date") if date_from is not None else F.col("full_date")
        last = F.lit(date_to).cast("date") if date_to is not None else F.col("full_date")
        sliced["dim_date"] = gold["dim_date"].where(F.col("full_date").between(first, last))
    if categories is not None:
        sliced["dim_product"] = gold["dim_product"].where(F.col("product_category").isin(*categories))
    filters = [("date_key", "dim_date", STORE_FACTS), ("store_key", "dim_store", STORE_FACTS)]
    filters.append(("product_key", "dim_product", ("fct_sales",)))
    for key, dimension, facts in filters:
        if sliced[dimension] is not gold[dimension]:
            for fact in facts:
                sliced[fact] = lookup_join(sliced[fact], sliced[dimension].select(key), [key], "left_semi")
    return sliced


def _sum(column, places=2):
    return F.coalesce(money(F.sum(column), places, 24), F.lit(0).cast(f"decimal(24,{places})"))


def sales_totals(gold):
    """Revenue, gross profit and gross margin."""
    return gold["fct_sales"].agg(
        _sum("gross_revenue").alias("revenue"),
        _sum("gross_profit").alias("gross_profit"),
        rate_or_zero(F.sum("gross_profit"), F.sum("gross_revenue")).alias("gross_margin_rate"),
    )


def monthly_revenue(gold):
    """Revenue per calendar month."""
    months = gold["dim_date"].select("date_key", "year_month")
    daily = gold["fct_sales"].groupBy("date_key").agg(F.sum("gross_revenue").alias("_revenue"))
    return star(daily, date_key=months).groupBy("year_month").agg(money(F.sum("_revenue"), 2, 24).alias("revenue"))


def revenue_growth(gold):
    """Revenue per month with the previous month and the percent change."""
    grown = period_growth(monthly_revenue(gold), "year_month", "revenue", name="mom_growth_pct")
    return grown.withColumnRenamed("previous", "previous_revenue")


def last_month(gold):
    """The last month with sales: revenue and growth."""
    return revenue_growth(gold).orderBy(F.desc("year_month")).limit(1)


def order_value(gold):
    """Orders (distinct transactions) and revenue per order."""
    return gold["fct_sales"].agg(
        F.countDistinct("transaction_id").alias("orders"),
        _sum("gross_revenue").alias("revenue"),
        F.coalesce(
            rounded_ratio(F.sum("gross_revenue"), F.countDistinct("transaction_id"), 2),
            F.lit(0).cast("decimal(18,2)"),
        ).alias("average_order_value"),
    )


def labor_cost_status(rate="labor_cost_rate"):
    """Class of a labor share given as a fraction."""
    return (
        F.when(F.col(rate) * 100 > fixed.LABOR_OVER, "OVER TARGET")
        .when(F.col(rate) * 100 > fixed.LABOR_WATCH, "WATCH")
        .otherwise("ON TARGET")
    )


def labor_share(gold):
    """Labor cost over revenue as a ratio of sums, and its status."""
    share = rate_or_zero("_cost", "_revenue")
    return (
        gold["fct_labor"]
        .agg(
            _sum("total_labor_cost").alias("_cost"),
            _sum("daily_revenue").alias("_revenue"),
        )
        .select(
            F.col("_cost").alias("labor_cost"), F.col("_revenue").alias("labor_revenue"), share.alias("labor_cost_rate")
        )
        .withColumn("labor_cost_status", labor_cost_status())
    )


def revenue_per_labor_hour(gold):
    return gold["fct_labor"].agg(
        _sum("daily_revenue").alias("labor_revenue"),
        _sum("total_hours_worked", 1).alias("hours_worked"),
        rate_or_zero(F.sum("daily_revenue"), F.sum("total_hours_worked"), 2).alias("revenue_per_labor_hour"),
    )


def _waste_columns():
    return [
        _sum("waste_amount_usd", 4).alias("waste_amount"),
        _sum("waste_qty", 4).alias("waste_qty"),
        rate_or_zero(F.abs(F.sum("waste_qty")), F.sum("theoretical_consumption")).alias("waste_rate"),
    ]


def waste_totals(gold):
    """Waste amount, quantity and absolute quantity over theoretical use."""
    return gold["fct_waste"].agg(*_waste_columns())


def waste_by_month(gold):
    months = gold["dim_date"].select("date_key", "year_month")
    return star(gold["fct_waste"], date_key=months).groupBy("year_month").agg(*_waste_columns())


def waste_by_ingredient(gold):
    return gold["fct_waste"].groupBy("ingredient_name").agg(*_waste_columns())


def labor_by_month(gold):
    """Revenue and labor share per month."""
    months = gold["dim_date"].select("date_key", "year_month")
    return (
        star(gold["fct_labor"], date_key=months)
        .groupBy("year_month")
        .agg(
            _sum("daily_revenue").alias("revenue"),
            rate_or_zero(F.sum("total_labor_cost"), F.sum("daily_revenue")).alias("labor_cost_rate"),
        )
    )


def last_snapshot(gold):
    """Inventory rows of the last snapshot date."""
    fact = gold["fct_inventory_snapshot"]
    return fact.where(F.col("snapshot_date") == fact.select(F.max("snapshot_date")).scalar())


def stockouts(gold):
    """Ingredients at HIGH risk on the last snapshot date."""
    high = F.count_if(F.col("stockout_risk_flag") == "HIGH").alias("stockout_high_count")
    return last_snapshot(gold).agg(F.max("snapshot_date").alias("snapshot_date"), high)


def stockouts_by_store(gold):
    stores = gold["dim_store"].select("store_key", "store_name")
    high = F.count_if(F.col("stockout_risk_flag") == "HIGH").alias("stockout_high_count")
    return star(last_snapshot(gold), store_key=stores).groupBy("store_name").agg(high)


def _mean_days():
    days = F.col("days_of_inventory_remaining")
    return rounded_ratio(F.sum(days), F.count(days), 2).alias("avg_days_inventory")


def inventory_totals(gold):
    """Mean days of stock, closing stock of the last snapshot, and units received."""
    fact = gold["fct_inventory_snapshot"]
    closing = last_snapshot(gold).agg(_sum("closing_stock").alias("closing_stock"))
    return fact.agg(_mean_days(), _sum("units_received").alias("units_received")).crossJoin(F.broadcast(closing))


def days_inventory_trend(gold):
    return gold["fct_inventory_snapshot"].groupBy("snapshot_date").agg(_mean_days())


def last_day_inventory(gold):
    """Days of stock and risk of each store and ingredient on the last snapshot date."""
    stores = gold["dim_store"].select("store_key", "store_name")
    return star(last_snapshot(gold), store_key=stores).select(
        "store_name",
        "ingredient_name",
        "snapshot_date",
        "closing_stock",
        "days_of_inventory_remaining",
        "stockout_risk_flag",
    )


def coverage_matrix(gold, store_names=tuple(s[1] for s in fixed.STORES)):
    """Mean days of stock with a row per ingredient and a column per store."""
    stores = gold["dim_store"].select("store_key", "store_name")
    days = F.col("days_of_inventory_remaining")
    by_store = [
        rounded_ratio(F.sum(F.when(F.col("store_name") == s, days)), F.count(F.when(F.col("store_name") == s, days)), 2)
        .alias(s)
        for s in store_names
    ]
    return star(gold["fct_inventory_snapshot"], store_key=stores).groupBy("ingredient_name").agg(*by_store)


def revenue_by(gold, *columns):
    """Revenue per attribute of the date, store or product dimension."""
    fact = gold["fct_sales"].groupBy("date_key", "store_key", "product_key").agg(F.sum("gross_revenue").alias("_revenue"))
    for key, dimension in (("date_key", "dim_date"), ("store_key", "dim_store"), ("product_key", "dim_product")):
        wanted = [c for c in columns if c in gold[dimension].columns and c not in fact.columns]
        if wanted:
            fact = star(fact, **{key: gold[dimension].select(key, *wanted)})
    return fact.groupBy(*columns).agg(money(F.sum("_revenue"), 2, 24).alias("revenue"))


def product_table(gold):
    """Revenue, gross margin and revenue rank per product."""
    totals = gold["fct_sales"].groupBy("product_name").agg(
        _sum("gross_revenue").alias("revenue"),
        rate_or_zero(F.sum("gross_profit"), F.sum("gross_revenue")).alias("gross_margin_rate"),
    )
    return rank_by(totals, "revenue", name="revenue_rank")
