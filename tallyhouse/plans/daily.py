"""The daily build: Bronze snapshots to staged tables, Gold tables, gates and export."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.calendar import covered_days
from tallyhouse.operators import staging
from tallyhouse.plans import dimensions, facts, intermediate, quality, rejects
from tallyhouse.schemas import ARRIVAL, GOLD_TABLES
from tallyhouse.sources import audit, bronze, gold


def silver_tables(tables, *, latest=True, lines=None, newest=None):
    """Staged tables from Bronze tables and the mapping; `lines` are POS lines staged already, without numbers.

    `newest` names the newest arrival of datasets (see `recent_bronze`): their staging filters that folder by its name and
    does not look for the greatest date in the data.
    """
    newest = newest or {}

    def staged(name, stage, *others):
        if name in newest:
            return stage(tables[name].where(F.col(ARRIVAL) == F.lit(newest[name])), *others, latest=False)
        return stage(tables[name], *others, latest=latest)

    if lines is None:
        lines = staged("bronze_pos_transactions", staging.stage_pos_lines, tables["product_name_mapping"])
    return {
        "stg_pos_transactions": staging.number_pos(lines),
        "stg_product_costs": staged("bronze_product_costs", staging.stage_costs),
        "stg_recipes_bom": staged("bronze_recipes_bom", staging.stage_bom),
        "stg_daily_inventory": staged("bronze_daily_inventory", staging.stage_inventory),
        "stg_staff_shifts": staged("bronze_staff_shifts", staging.stage_shifts),
        "stg_promotions": staging.stage_promotions(tables["bronze_promotions"]),
    }


BUSINESS_DATES = {
    "stg_pos_transactions": "transaction_date",
    "stg_daily_inventory": "inventory_date",
    "stg_staff_shifts": "shift_date",
}


def business_calendar(silver):
    """Calendar from the first to the last staged business date, so that every fact finds its day."""
    ends = [silver[name].agg(F.min(day).alias("a"), F.max(day).alias("b")) for name, day in BUSINESS_DATES.items()]
    days = reduce(DataFrame.union, ends).select(F.explode(F.array("a", "b")).alias("day"))
    return dimensions.calendar_of(covered_days(days, "day"))


def dimension_tables(spark, silver, calendar=None):
    """Dimensions of the staged tables; `calendar` is (first day, day after the last), by default what the data spans."""
    lines = silver["stg_pos_transactions"]
    return {
        "dim_date": dimensions.build_dim_date(spark, *calendar) if calendar else business_calendar(silver),
        "dim_store": dimensions.build_dim_store(lines),
        "dim_product": dimensions.build_dim_product(lines, silver["stg_product_costs"]),
        "dim_ingredient": dimensions.build_dim_ingredient(silver["stg_recipes_bom"]),
    }


def fact_tables(silver, dims):
    lines, counts = silver["stg_pos_transactions"], silver["stg_daily_inventory"]
    sales = intermediate.sales_with_costs(lines, silver["stg_product_costs"])
    theoretical = intermediate.theoretical_consumption(lines, silver["stg_recipes_bom"])
    labor = intermediate.labor_by_day(silver["stg_staff_shifts"], lines)
    date, store = dims["dim_date"], dims["dim_store"]
    return {
        "fct_sales": facts.build_fct_sales(sales, date, store, dims["dim_product"]),
        "fct_waste": facts.build_fct_waste(theoretical, counts, date, store, dims["dim_ingredient"]),
        "fct_labor": facts.build_fct_labor(labor, date, store),
        "fct_inventory_snapshot": facts.build_fct_inventory_snapshot(counts, date, store),
    }


def build_gold(spark, tables, root, *, calendar=None, lines=None, newest=None):
    """Build and store the staged tables, then the dimensions, then the facts.

    Each stored layer ends the lineage of the next: POS lines are parsed,
    numbered and named once although four facts and two dimensions read them,
    and the dimensions' true sizes are known when the facts are planned. The
    sales fact is partitioned by day, so reports on a date range read only its
    folders; the other facts are daily totals and too small for that.
    """
    staged = silver_tables(tables, lines=lines, newest=newest)
    for name, df in staged.items():
        gold.write_table(df, root, name, "silver")
    silver = {name: gold.read_table(spark, root, name, "silver") for name in staged}
    for name, df in dimension_tables(spark, silver, calendar).items():
        gold.write_table(df, root, name)
    dims = {name: gold.read_table(spark, root, name) for name in GOLD_TABLES if name.startswith("dim_")}
    for name, df in fact_tables(silver, dims).items():
        gold.write_table(df, root, name, partition_by=["date_key"] if name == "fct_sales" else [])
    return silver, gold.read_gold(spark, root)


def recent_bronze(spark, root):
    """(tables, newest): Bronze tables for a daily run without the history it can't use, and the newest arrival of each.

    Staging and the gates look at the newest snapshot, or, where lines meet shifts, at the older of the two newest. All
    dates come from the folder listing, so other folders are not opened. Promotions count with all their loads.
    """
    paired = ("bronze_pos_transactions", "bronze_staff_shifts")
    snapshots = (*paired, "bronze_product_costs", "bronze_recipes_bom", "bronze_daily_inventory")
    newest = {name: bronze.latest_arrival(spark, bronze.dataset_path(root, name)) for name in snapshots}
    newest = {name: date for name, date in newest.items() if date is not None}
    tables = {}
    for name in bronze.DATASETS:
        if name in paired or name not in snapshots:
            tables[name] = bronze.read_bronze(spark, root, name)
        else:
            tables[name] = bronze.read_bronze(spark, root, name, latest=True)
    since = min(newest[name] for name in paired)
    for name in paired:
        tables[name] = tables[name].where(F.col(ARRIVAL) >= F.lit(since))
    return tables, newest


def run_daily(spark, bronze_root, mapping, lake_root, run_date, *, export_to=None, calendar=None, keep_rejects=False):
    """Gates before, build, gates after, export and run summary for one run date.

    A failing critical gate stops the run; the summary is written either way. With `keep_rejects` the rejected POS lines are
    stored with their reasons, and the parity gate reads the counts of that scan instead of counting both layers.
    """
    store = audit.gate_store(f"{lake_root}/quality-gate-results")
    tables, newest = recent_bronze(spark, bronze_root)
    tables |= {"product_name_mapping": mapping}
    step = "quality_gates_pre"
    try:
        profile = quality.pos_profile(tables["bronze_pos_transactions"])
        gold.write_table(profile, lake_root, "pos_profile", "silver")
        tables["pos_profile"] = gold.read_table(spark, lake_root, "pos_profile", "silver")
        quality.run_gates(spark, tables, ["completeness", "integrity"], run_date=run_date, store=store)
        step = "build"
        lines = None
        if keep_rejects:
            name = "bronze_pos_transactions"
            own = tables[name].where(F.col(ARRIVAL) == F.lit(newest[name]))
            tables["pos_line_counts"] = rejects.write_lines(spark, own, lake_root, latest=False)
            lines = rejects.kept_lines(spark, lake_root, mapping)
        silver, tables_out = build_gold(spark, tables, lake_root, calendar=calendar, lines=lines, newest=newest)
        step = "quality_gates_post"
        after = tables | {"stg_pos_transactions": silver["stg_pos_transactions"]}
        quality.run_gates(spark, after, ["consistency", "parity"], run_date=run_date, store=store)
        step = "export"
        if export_to is not None:
            gold.export_snapshot(tables_out, export_to)
    except Exception:
        failed = audit.run_summary(spark, run_date=run_date, run_id=run_date, status="FAILED", failed_tasks=[step])
        audit.write_run_summary(failed, lake_root)
        raise
    audit.write_run_summary(audit.run_summary(spark, run_date=run_date, run_id=run_date, status="SUCCESS"), lake_root)
    return tables_out
