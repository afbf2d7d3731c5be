"""Declarative column tests. Each returns the violating rows; none means the test passes."""

from pyspark.sql import functions as F

from tallyhouse.operators.joins import missing_in


def unique(df, column):
    """Non-null values that occur more than once, with their count."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where(F.col("n_records") > 1)


def not_null(df, column):
    return df.where(F.col(column).isNull())


def relationships(df, column, parent, field):
    """Rows whose value is set but absent from the parent table."""
    return missing_in(df, parent, {column: field})


def accepted_values(df, column, values):
    """Values outside the list, with their count; NULL is accepted."""
    outside = df.where(~F.col(column).isin(*values))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def accepted_range(df, column, low=None, high=None):
    """Rows outside the inclusive bounds; NULL is accepted."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return df.where(bad)


# The tests the Gold tables carry, as (table, column, test, arguments).
GOLD_TESTS = (
    ("fct_sales", "sales_key", "unique", {}),
    ("fct_sales", "sales_key", "not_null", {}),
    ("fct_sales", "date_key", "not_null", {}),
    ("fct_sales", "date_key", "relationships", {"parent": "dim_date", "field": "date_key"}),
    ("fct_sales", "store_key", "not_null", {}),
    ("fct_sales", "store_key", "relationships", {"parent": "dim_store", "field": "store_key"}),
    ("fct_sales", "transaction_qty", "not_null", {}),
    ("fct_sales", "transaction_qty", "accepted_range", {"low": 1}),
    ("fct_sales", "gross_margin_pct", "accepted_range", {"low": -100, "high": 100}),
    ("fct_waste", "waste_key", "unique", {}),
    ("fct_waste", "waste_key", "not_null", {}),
    ("fct_waste", "waste_rate_pct", "accepted_range", {"low": -100, "high": 1000}),
    ("fct_labor", "labor_key", "unique", {}),
    ("fct_labor", "labor_key", "not_null", {}),
    ("fct_labor", "labor_status", "accepted_values", {"values": ["ON TARGET", "WATCH", "OVER TARGET"]}),
    ("fct_inventory_snapshot", "snapshot_key", "unique", {}),
    ("fct_inventory_snapshot", "snapshot_key", "not_null", {}),
    ("fct_inventory_snapshot", "stockout_risk_flag", "accepted_values", {"values": ["HIGH", "MEDIUM", "LOW"]}),
    ("dim_date", "date_key", "unique", {}),
    ("dim_date", "date_key", "not_null", {}),
    ("dim_store", "store_key", "unique", {}),
    ("dim_store", "store_key", "not_null", {}),
    ("dim_store", "store_id", "unique", {}),
    ("dim_store", "store_id", "not_null", {}),
    ("dim_store", "store_id", "accepted_values", {"values": [3, 5, 8]}),
    ("dim_product", "product_key", "unique", {}),
    ("dim_product", "product_key", "not_null", {}),
    (
        "dim_product",
        "margin_tier",
        "accepted_values",
        {"values": ["High Margin", "Medium Margin", "Low Margin", "Unknown"]},
    ),
    ("dim_ingredient", "ingredient_key", "unique", {}),
    ("dim_ingredient", "ingredient_key", "not_null", {}),
)

CHECKS = {
    "unique": unique,
    "not_null": not_null,
    "relationships": relationships,
    "accepted_values": accepted_values,
    "accepted_range": accepted_range,
}


def tested_columns(table, tests=GOLD_TESTS):
    """Columns of a table that the declared tests look at, as a child or as a parent."""
    own = [column for name, column, _, _ in tests if name == table]
    parents = [arguments["field"] for _, _, _, arguments in tests if arguments.get("parent") == table]
    return list(dict.fromkeys([*own, *parents]))


def constraint_violations(gold, test):
    """The violating rows of one declared test."""
    table, column, check, arguments = test
    arguments = dict(arguments)
    if check == "relationships":
        arguments["parent"] = gold[arguments["parent"]]
    return CHECKS[check](gold[table], column, **arguments)


def constraint_report(gold, tests=GOLD_TESTS):
    """One row per declared test with its number of violations.

    Tests that look at single rows of a table share one scan of it; only
    uniqueness and relationships need their own.
    """
    reports = []
    single = {}
    for test in tests:
        table, column, check, arguments = test
        if check in ("unique", "relationships"):
            found = constraint_violations(gold, test).agg(F.count(F.lit(1)).alias("violations"))
            reports.append(found.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                                        F.lit(check).alias("test"), "violations"))
        else:
            single.setdefault(table, []).append((column, check, arguments))
    for table, checks in single.items():
        counts = [F.count_if(_row_violates(*check)).alias(f"_{i}") for i, check in enumerate(checks)]
        one = gold[table].agg(*counts)
        rows = F.explode(F.array(*[
            F.struct(F.lit(column).alias("column_name"), F.lit(check).alias("test"), F.col(f"_{i}").alias("violations"))
            for i, (column, check, _) in enumerate(checks)
        ])).alias("t")
        reports.append(one.select(rows).select(F.lit(table).alias("table_name"), "t.*"))
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report


def _row_violates(column, check, arguments):
    c = F.col(column)
    if check == "not_null":
        return c.isNull()
    if check == "accepted_values":
        return F.coalesce(~c.isin(*arguments["values"]), F.lit(False))
    low, high = arguments.get("low"), arguments.get("high")
    bad = F.lit(False)
    if low is not None:
        bad = bad | F.coalesce(c < low, F.lit(False))
    if high is not None:
        bad = bad | F.coalesce(c > high, F.lit(False))
    return bad
