"""Join shapes: lookups into reference tables, validity ranges, recipes, missing rows.

Reference tables (costs, recipes, mapping, dimensions) are usually small, but nothing promises it. A lookup is an equality
join without hints: the planner broadcasts a table whose files are small, adaptive execution one whose measured shuffle
output is, and it splits the partitions of a key that holds a large part of all rows. The session settings in
`tallyhouse.session` say how small, and that skewed partitions are split even where that costs a shuffle.
"""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F


def lookup_join(facts, table, keys, how="left", *, within=None, null_safe=False):
    """Join facts to a reference table on equally named keys; `within` adds a condition on columns other than the keys."""
    renamed = {key: f"_{key}_ref" for key in keys}
    right = table.withColumnsRenamed(renamed)
    conditions = [
        F.col(key).eqNullSafe(F.col(ref)) if null_safe else F.col(key) == F.col(ref)
        for key, ref in renamed.items()
    ]
    if within is not None:
        conditions.append(within)
    return facts.join(right, reduce(and_, conditions), how).drop(*renamed.values())


def join_valid(lines, costs, *, key="product_name", date_col="transaction_date",
               valid_from="valid_from", valid_to="valid_to"):
    """Left join lines to the costs in force on their date; both bounds belong to the interval.

    Overlapping intervals give one output row each.
    """
    within = F.col(date_col).between(F.col(valid_from), F.col(valid_to))
    return lookup_join(lines, costs, [key], "left", within=within)


def explode_bom(sales, bom, *, key="product_name"):
    """Inner join of pre-aggregated sales to recipe rows; products without a recipe drop out."""
    return lookup_join(sales, bom, [key], "inner")


def canonicalise(lines, mapping, *, name_col="product_name_raw", default_group="unclassified"):
    """Canonical product names; an unmapped product keeps its own name and needs cost and recipe."""
    names = mapping.select(
        F.col("pos_product_detail").alias(name_col),
        F.col("canonical_product_name").alias("_canonical"),
        "size_code",
        F.col("cost_required").alias("_cost"),
        F.col("recipe_required").alias("_recipe"),
        F.col("product_group").alias("_group"),
    )
    return (
        lookup_join(lines, names, [name_col])
        .withColumns(
            {
                "product_name": F.coalesce("_canonical", name_col),
                "cost_required": F.coalesce("_cost", F.lit(True)),
                "recipe_required": F.coalesce("_recipe", F.lit(True)),
                "product_group": F.coalesce("_group", F.lit(default_group)),
            }
        )
        .drop("_canonical", "_cost", "_recipe", "_group")
    )


def lookup_keys(fact, lookups):
    """Add surrogate keys: each lookup is `(dimension, {fact column: natural key}, key column)`."""
    for dimension, natural, key in lookups:
        table = dimension.select(
            *[F.col(theirs).alias(ours) for ours, theirs in natural.items()], F.col(key)
        )
        fact = lookup_join(fact, table, list(natural))
    return fact


def missing_in(child, parent, on):
    """Child rows whose key is set but has no parent; `on` maps child to parent columns."""
    keys = parent.select(*[F.col(theirs).alias(ours) for ours, theirs in on.items()]).distinct()
    return lookup_join(child.dropna(subset=list(on)), keys, list(on), "left_anti")
