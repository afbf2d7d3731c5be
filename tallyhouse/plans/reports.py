"""Business reports over the Gold tables; `gold` maps table names to DataFrames."""

from pyspark.sql import functions as F

from tallyhouse.functions.numbers import mean, money, rounded_ratio
from tallyhouse.operators.joins import lookup_join


def star(fact, **lookups):
    """Inner join a fact to dimensions on their surrogate keys; `key=dimension`, each with its columns."""
    for key, dimension in lookups.items():
        fact = lookup_join(fact, dimension, [key], "inner")
    return fact


def product_margins(gold):
    """Units, revenue, mean margin and profit per product.

    Facts are summed per product key before the dimension joins. A key listed
    several times in the dimension gives its totals to each listing, as a
    line-level join would.
    """
    totals = gold["fct_sales"].groupBy("product_key").agg(
        F.sum("transaction_qty").alias("units_sold"),
        F.sum("gross_revenue").alias("_revenue"),
        F.sum("gross_margin_pct").alias("_margin"),
        F.count("gross_margin_pct").alias("_margins"),
        F.sum("gross_profit").alias("_profit"),
    )
    products = gold["dim_product"].select("product_key", "product_name", "product_category", "margin_tier")
    return (
        star(totals, product_key=products)
        .groupBy("product_name", "product_category", "margin_tier")
        .agg(
            F.sum("units_sold").alias("units_sold"),
            money(F.sum("_revenue"), 2, 24).alias("total_revenue"),
            rounded_ratio(F.sum("_margin"), F.sum("_margins"), 2).alias("avg_margin_pct"),
            money(F.sum("_profit"), 2, 24).alias("total_gross_profit"),
        )
    )




def top_margin_products(gold, n=10):
    """Products with the best mean margin; equal margins are listed by name."""
    order = [F.desc_nulls_last("avg_margin_pct"), "product_name", "product_category", "margin_tier"]
    return product_margins(gold).orderBy(*order).limit(n)


def labor_efficiency(gold):
    """Mean labor share, cost, revenue and days over target per month, week and store."""
    days = gold["dim_date"].select("date_key", "year_month", "week_num")
    stores = gold["dim_store"].select("store_key", "store_location")
    return (
        star(gold["fct_labor"], date_key=days, store_key=stores)
        .groupBy("year_month", "week_num", "store_location")
        .agg(
            mean("labor_cost_pct").alias("avg_labor_pct"),
            money(F.sum("total_labor_cost"), 2, 24).alias("total_labor_cost"),
            money(F.sum("daily_revenue"), 2, 24).alias("total_revenue"),
            F.count_if(F.col("labor_status") == "OVER TARGET").alias("days_over_target"),
        )
    )


def labor_efficiency_trend(gold):
    return labor_efficiency(gold).orderBy("year_month", "week_num", "store_location")


def weekly_waste(gold, *, as_of=None, days=7):
    """Waste per store and ingredient since `days` days before `as_of`.

    Without `as_of` the last day of the waste fact counts as today.
    """
    fact = gold["fct_waste"]
    last = F.lit(as_of).cast("date") if as_of is not None else fact.select(F.max("transaction_date")).scalar()
    calendar = gold["dim_date"].select("date_key", "full_date")
    stores = gold["dim_store"].select("store_key", "store_location")
    return (
        star(fact, date_key=calendar.where(F.col("full_date") >= F.date_sub(last, days)), store_key=stores)
        .groupBy("store_location", "ingredient_name")
        .agg(
            money(F.sum("waste_amount_usd"), 2, 24).alias("waste_usd"),
            mean("waste_rate_pct").alias("avg_waste_rate_pct"),
            F.max("waste_rate_pct").alias("max_waste_rate_pct"),
        )
    )


def weekly_waste_by_store(gold, **options):
    return weekly_waste(gold, **options).orderBy(F.desc_nulls_last("waste_usd"), "store_location", "ingredient_name")
