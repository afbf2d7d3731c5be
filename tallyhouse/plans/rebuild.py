"""Rebuild of the days a new arrival changes: fingerprints of the inputs tell which, the other folders stay.

Every build leaves fingerprints of its staged inputs: one per business day of dated inputs, one per product or store of
undated ones. The next build compares. A fact's changed days follow from what it reads:

- sales: days whose lines changed, and days that sold a product whose cost or listing, or in a store whose listing changed
- waste: days whose lines or counts changed, and days that sold a product whose recipe changed or use an ingredient whose
  listing changed
- labor: days whose shifts or lines changed
- inventory: days whose counts changed, and the next records of each series whose trailing mean looks back on them

Facts are partitioned by business day. Changed days are overwritten as dynamic partitions; a day that has no rows any more
loses its folder. Fingerprints are stored last, so that a run that breaks off is repeated in full.
"""

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions.fingerprints import changed_members, fingerprints_by
from tallyhouse.plans import facts, intermediate
from tallyhouse.sources import gold
from tallyhouse.sources.files import delete, exists

FINGERPRINTS = "input_fingerprints"
# The business day that each fact's folders stand for.
FACT_DAYS = {
    "fct_sales": "transaction_date",
    "fct_waste": "transaction_date",
    "fct_labor": "shift_date",
    "fct_inventory_snapshot": "snapshot_date",
}
FOLDER = "business_day"
KEYS = ["input", "member"]


def input_fingerprints(silver, dims):
    """Fingerprints (input, member, n_rows, hash_sum, hash_xor) of staged inputs and of the dimensions' listings."""
    listings = {"dim_product": "product_name", "dim_store": "store_id", "dim_ingredient": "ingredient_name"}
    inputs = [
        ("lines", silver["stg_pos_transactions"].drop("ingestion_date"), "transaction_date"),
        ("counts", silver["stg_daily_inventory"].drop("ingestion_date"), "inventory_date"),
        ("shifts", silver["stg_staff_shifts"].drop("ingestion_date"), "shift_date"),
        ("costs", silver["stg_product_costs"].drop("ingestion_date"), "product_name"),
        ("recipes", silver["stg_recipes_bom"].drop("ingestion_date", "last_updated"), "product_name"),
        # Facts take nothing but keys from a dimension, once for each of its rows.
        *[(name, dims[name].select(member, name.replace("dim_", "") + "_key"), member) for name, member in listings.items()],
        ("dim_date", dims["dim_date"].select("full_date", "date_key"), "full_date"),
    ]
    out = None
    for name, df, member in inputs:
        rows = df.withColumn("member", F.col(member).cast("string"))
        found = fingerprints_by(rows, ["member"]).withColumn("input", F.lit(name))
        out = found if out is None else out.unionByName(found)
    return out.select(*KEYS, "n_rows", "hash_sum", "hash_xor")


def _days(changed, *inputs):
    return changed.where(F.col("input").isin(*inputs)).select(F.col("member").try_cast("date").alias("day")).distinct()


def _days_of(rows, day, column, changed, *inputs):
    """Days of the rows whose column names a changed member; the changed members are few, the rows are grouped first."""
    members = changed.where(F.col("input").isin(*inputs)).select("member").distinct()
    seen = rows.select(F.col(day).alias("day"), F.col(column).cast("string").alias("member")).distinct()
    return seen.join(members, "member", "left_semi").select("day")


def trailing_days(counts, days, n=fixed.TRAILING_RECORDS):
    """Days with a record whose trailing mean over `n` records looks back on a changed day, the changed days included.

    A record is concerned if a changed day lies after the n-th record before it: then that day's record is among its last
    n, or was before it was removed.
    """
    series = Window.partitionBy("store_id", "ingredient_name").orderBy("inventory_date")
    records = counts.select(
        F.col("inventory_date").alias("day"), F.lag("inventory_date", n).over(series).alias("before")
    ).distinct()
    known = records.select("day", F.lit(None).cast("date").alias("changed")).union(days.select("day", "day"))
    # One row for each calendar day, with the last changed day up to it.
    calendar = known.groupBy("day").agg(F.max("changed").alias("changed"))
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    calendar = calendar.select("day", F.last("changed", ignorenulls=True).over(upto).alias("last"))
    concerned = F.col("last").isNotNull() & (F.col("before").isNull() | (F.col("last") > F.col("before")))
    return records.join(calendar, "day").where(concerned).select("day").union(days.select("day")).distinct()


def affected_days(changed, silver):
    """Changed days of each fact, as one-column tables."""
    lines, counts = silver["stg_pos_transactions"], silver["stg_daily_inventory"]
    calendar = _days(changed, "dim_date")
    by_product = _days_of(lines, "transaction_date", "product_name", changed, "costs", "dim_product")
    by_store = _days_of(lines, "transaction_date", "store_id", changed, "dim_store")
    by_recipe = _days_of(lines, "transaction_date", "product_name", changed, "recipes")
    recipes = silver["stg_recipes_bom"].select("product_name", "ingredient_name")
    listed = changed.where("input = 'dim_ingredient'").select(F.col("member").alias("ingredient_name"))
    products = recipes.join(listed, "ingredient_name", "left_semi").select(
        F.lit("recipes").alias("input"), F.col("product_name").alias("member")
    )
    by_ingredient = _days_of(lines, "transaction_date", "product_name", products, "recipes")
    count_days = _days(changed, "counts").union(_days_of(counts, "inventory_date", "store_id", changed, "dim_store"))
    shift_days = _days_of(silver["stg_staff_shifts"], "shift_date", "store_id", changed, "dim_store")
    return {
        "fct_sales": _days(changed, "lines").union(by_product).union(by_store).union(calendar).distinct(),
        "fct_waste": _days(changed, "lines", "counts").union(by_recipe).union(by_ingredient).union(by_store).union(calendar).distinct(),
        "fct_labor": _days(changed, "lines", "shifts").union(shift_days).union(calendar).distinct(),
        "fct_inventory_snapshot": trailing_days(counts, count_days.union(calendar).distinct()),
    }


def facts_of_days(silver, dims, days):
    """The facts of the given days only: inputs are cut to the days before any join; counts keep the records trailing means need."""
    date, store = dims["dim_date"], dims["dim_store"]

    def within(df, column, fact):
        return df.where(F.col(column).isin(*days[fact])) if days[fact] else df.limit(0)

    lines, counts = silver["stg_pos_transactions"], silver["stg_daily_inventory"]
    sales = intermediate.sales_with_costs(within(lines, "transaction_date", "fct_sales"), silver["stg_product_costs"])
    theoretical = intermediate.theoretical_consumption(within(lines, "transaction_date", "fct_waste"), silver["stg_recipes_bom"])
    labor = intermediate.labor_by_day(
        within(silver["stg_staff_shifts"], "shift_date", "fct_labor"), within(lines, "transaction_date", "fct_labor")
    )
    stock = facts.build_fct_inventory_snapshot(counts, date, store)
    return {
        "fct_sales": facts.build_fct_sales(sales, date, store, dims["dim_product"]),
        "fct_waste": facts.build_fct_waste(theoretical, within(counts, "inventory_date", "fct_waste"), date, store, dims["dim_ingredient"]),
        "fct_labor": facts.build_fct_labor(labor, date, store),
        "fct_inventory_snapshot": within(stock, "snapshot_date", "fct_inventory_snapshot"),
    }


def _folder(day):
    return f"{FOLDER}={day.isoformat()}"


def replace_days(df, root, fact, days):
    """Overwrite the folders of these days with the rows of `df`, which holds no other day; emptied days lose theirs."""
    path = gold.table_path(root, fact)
    seen = Observation(fact)
    rows = df.withColumn(FOLDER, F.col(FACT_DAYS[fact]).cast("string")).hint("rebalance", F.col(FOLDER))
    rows = rows.observe(seen, F.collect_set(FOLDER).alias("days"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(FOLDER).parquet(path)
    filled = set(seen.get["days"])
    for day in days:
        folder = f"{path}/{_folder(day)}"
        if day.isoformat() not in filled and exists(df.sparkSession, folder):
            delete(df.sparkSession, folder)


def rebuild(spark, silver, dims, root, *, only=tuple(FACT_DAYS)):
    """Bring the stored facts up to date with the staged inputs; returns {fact: sorted list of rebuilt days}.

    Days are bounded by the calendar, so their lists are small. Without stored fingerprints every day counts as changed.
    Rows without a business day belong to no folder and are not stored. `only` names the facts kept below `root`; it must
    be the same in every run.
    """
    gold.write_table(input_fingerprints(silver, dims), root, f"{FINGERPRINTS}_next", "silver")
    fresh = gold.read_table(spark, root, f"{FINGERPRINTS}_next", "silver")
    stored = gold.table_path(root, FINGERPRINTS, "silver")
    known = gold.read_table(spark, root, FINGERPRINTS, "silver") if exists(spark, f"{stored}/_SUCCESS") else fresh.limit(0)
    gold.write_table(changed_members(fresh, known, KEYS), root, "changed_members", "silver")
    changed = gold.read_table(spark, root, "changed_members", "silver")
    found = affected_days(changed, silver)
    days = {fact: sorted(r.day for r in found[fact].collect() if r.day is not None) for fact in only}
    wanted = facts_of_days(silver, dims, {fact: days.get(fact, []) for fact in FACT_DAYS})
    for fact in only:
        if days[fact]:
            replace_days(wanted[fact], root, fact, days[fact])
    gold.write_table(fresh, root, FINGERPRINTS, "silver")
    return days


def read_fact(spark, root, fact):
    """A fact kept by `rebuild`, without the folder column."""
    return gold.read_table(spark, root, fact).drop(FOLDER)
