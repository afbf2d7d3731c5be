"""Dimension tables."""

from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions.calendar import calendar_columns, date_spine
from tallyhouse.functions.keys import surrogate_key
from tallyhouse.operators.intervals import versions_by_interval
from tallyhouse.operators.joins import lookup_join


def build_dim_date(spark, start=fixed.CALENDAR_START, end_exclusive=fixed.CALENDAR_STOP):
    """One row per day of the range."""
    return calendar_of(date_spine(spark, start, end_exclusive))


def calendar_of(days):
    """Calendar attributes of a table of days."""
    return days.select(*calendar_columns())


def build_dim_store(lines, stores=fixed.STORES, city=fixed.STORE_CITY, open_date=fixed.STORE_OPEN_DATE):
    """Stores seen in the lines; names and boroughs come from the lookup, else from the location."""
    name, borough = F.col("store_location"), F.lit(None).cast("string")
    for store_id, store_name, store_borough in stores:
        known = F.col("store_id") == store_id
        name = F.when(known, store_name).otherwise(name)
        borough = F.when(known, store_borough).otherwise(borough)
    return (
        lines.select("store_id", "store_location")
        .distinct()
        .select(
            surrogate_key("store_id").alias("store_key"),
            "store_id",
            "store_location",
            name.alias("store_name"),
            borough.alias("borough"),
            F.lit(city).alias("city"),
            F.lit(open_date).cast("date").alias("open_date"),
        )
    )


def product_attributes(lines):
    """Canonical products with one category, type and group each, the smallest by text."""
    return lines.groupBy("product_name").agg(
        *[F.min(c).alias(c) for c in ("product_category", "product_type", "product_group")]
    )


def margin_tier(cogs_pct="cogs_pct"):
    margin = 1 - F.col(cogs_pct)
    return (
        F.when(F.col(cogs_pct).isNull(), "Unknown")
        .when(margin >= F.lit(fixed.MARGIN_HIGH).cast("decimal(3,2)"), "High Margin")
        .when(margin >= F.lit(fixed.MARGIN_MEDIUM).cast("decimal(3,2)"), "Medium Margin")
        .otherwise("Low Margin")
    )


def build_dim_product(lines, costs, *, as_of=None):
    """Products sold with their costs and margin tier.

    A product with several cost intervals has one row each; `as_of` keeps the
    interval in force on that day only.
    """
    if as_of is not None:
        costs = costs.where(F.lit(as_of).cast("date").between(F.col("valid_from"), F.col("valid_to")))
    attributes = costs.select(
        "product_name",
        F.col("product_category").alias("_cost_category"),
        "unit_price_std",
        "unit_cost",
        "cogs_pct",
        "valid_from",
        "valid_to",
        "source_system",
    )
    return lookup_join(product_attributes(lines), attributes, ["product_name"]).select(
        surrogate_key("product_name").alias("product_key"),
        "product_name",
        F.coalesce("_cost_category", "product_category").alias("product_category"),
        "product_type",
        "product_group",
        "unit_price_std",
        "unit_cost",
        "cogs_pct",
        "valid_from",
        "valid_to",
        "source_system",
        margin_tier().alias("margin_tier"),
    )


def build_dim_product_versions(lines, costs):
    """Products sold with one row for each elementary interval of their costs: of overlapping versions the last to start.

    Intervals of a product are disjoint, so a lookup by product and day finds one row at most, and `version_key` (product
    and first day) is unique. A product without a cost has one row without bounds.
    """
    own = costs.select("product_name", "unit_cost", "valid_from", "valid_to")
    versions = versions_by_interval(own, ["product_name"], latest=True).select(
        "product_name", "unit_cost", F.col("seg_from").alias("valid_from"), F.col("seg_to").alias("valid_to")
    )
    return product_attributes(lines).join(versions, "product_name", "left").select(
        surrogate_key("product_name", "valid_from").alias("version_key"),
        "product_name", "product_category", "product_type", "product_group", "unit_cost", "valid_from", "valid_to",
    )


def build_dim_ingredient(bom):
    """Ingredients of the recipes; differing units or costs give several rows."""
    return (
        bom.select("ingredient_name", "unit_of_measure", "ingredient_cost_per_unit")
        .distinct()
        .select(
            surrogate_key("ingredient_name").alias("ingredient_key"),
            "ingredient_name",
            "unit_of_measure",
            F.col("ingredient_cost_per_unit").alias("cost_per_unit"),
        )
    )
