"""Coverage diagnostics and the name-mapping backlog."""

from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions.text import size_code, without_size
from tallyhouse.operators.joins import lookup_join, missing_in
from tallyhouse.schemas import ARRIVAL


def products_without_cost(pos, costs):
    """POS products without a cost of the same name, or whose cost is NULL, with their line count.

    Lines are counted per product before the join; a product listed with
    several NULL costs counts its lines once for each.
    """
    sold = (
        pos.where(F.col(ARRIVAL).isNotNull())
        .groupBy("product_detail")
        .agg(F.count(F.lit(1)).alias("transactions"))
        .withColumn("_name", F.trim("product_detail"))
    )
    listed = costs.select(F.trim("product_name").alias("_name"), "unit_cost")
    return (
        lookup_join(sold, listed, ["_name"])
        .where(F.col("unit_cost").isNull())
        .groupBy(F.col("product_detail").alias("product_name"), "unit_cost")
        .agg(F.sum("transactions").alias("transactions"))
        .withColumn("status", F.lit("NO COST - map or extend synthetic catalog"))
        .select("product_name", "transactions", "unit_cost", "status")
    )


def recipe_coverage(pos, bom):
    """Distinct transactions and recipe ingredients per POS product.

    Both sides are counted before they meet, so the join never multiplies
    lines by ingredients.
    """
    sold = (
        pos.where(F.col(ARRIVAL).isNotNull())
        .groupBy("product_detail")
        .agg(F.countDistinct("transaction_id").alias("transactions"))
        .withColumn("_name", F.trim("product_detail"))
    )
    recipes = bom.groupBy(F.trim("product_name").alias("_name")).agg(
        F.countDistinct("ingredient_name").alias("_ingredients")
    )
    ingredients = F.coalesce("_ingredients", F.lit(0).cast("bigint"))
    return lookup_join(sold, recipes, ["_name"]).select(
        F.col("product_detail").alias("product_name"),
        "transactions",
        ingredients.alias("ingredients_in_recipe"),
        F.when(ingredients == 0, "NO RECIPE - map or extend synthetic catalog").otherwise("OK").alias("status"),
    )


def mapping_backlog(pos, mapping, costs, bom, *, no_recipe=fixed.NO_RECIPE_CATEGORIES):
    """Unmapped POS products with a suggested canonical name, flags and what is still missing.

    Cost rows are not made distinct: a product with several cost intervals is
    listed once for each, as every snapshot counts.
    """
    name = F.col("pos_product_detail")
    products = (
        pos.where(F.col(ARRIVAL).isNotNull())
        .groupBy(F.trim("product_detail").alias("pos_product_detail"), F.trim("product_category").alias("product_category"))
        .agg(F.count(F.lit(1)).alias("transactions"))
    )
    mapped = mapping.select(F.trim("pos_product_detail").alias("pos_product_detail"))
    unnamed = products.where(name.isNull())
    unmapped = missing_in(products, mapped, {"pos_product_detail": "pos_product_detail"}).unionByName(unnamed)
    required = F.when(F.col("product_category").isin(*no_recipe), "false").otherwise("true")
    suggested = unmapped.withColumns(
        {
            "suggested_canonical_product_name": without_size(name),
            "suggested_size_code": size_code(name),
            "suggested_cost_required": required,
            "suggested_recipe_required": required,
        }
    )
    key = "suggested_canonical_product_name"
    costed = costs.where(F.col("product_name").isNotNull()).select(
        F.col("product_name").alias(key), F.lit(True).alias("_cost")
    )
    cooked = bom.select(F.col("product_name").alias(key)).distinct().withColumn("_recipe", F.lit(True))
    both = lookup_join(lookup_join(suggested, costed, [key]), cooked, [key])
    has_cost, has_recipe = F.coalesce("_cost", F.lit(False)), F.coalesce("_recipe", F.lit(False))
    action = (
        F.when(has_cost & has_recipe, "Add mapping only")
        .when(has_recipe, "Add mapping + cost")
        .when(has_cost, "Add mapping + recipe")
        .otherwise("Add mapping + cost + recipe")
    )
    return both.select(
        "pos_product_detail",
        "product_category",
        F.col("transactions").cast("string").alias("transactions"),
        "suggested_canonical_product_name",
        "suggested_size_code",
        "suggested_cost_required",
        "suggested_recipe_required",
        F.lit("false").alias("has_mapping"),
        has_cost.cast("string").alias("has_cost_for_suggested"),
        has_recipe.cast("string").alias("has_recipe_for_suggested"),
        action.alias("suggested_action"),
    )


def order_backlog(backlog):
    """Backlog for review: most sold first, then by name."""
    return backlog.orderBy(F.col("transactions").cast("bigint").desc(), "pos_product_detail")


def backlog_summary(backlog):
    """Number of backlog rows per suggested action, most frequent first."""
    counts = backlog.groupBy("suggested_action").agg(F.count(F.lit(1)).alias("n_products"))
    return counts.orderBy(F.desc("n_products"), "suggested_action")
