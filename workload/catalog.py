"""Registered queries: name -> (DataFrame of the bound tables, equivalent SQL or None).

Names start with the operator's inventory id. Outputs use fixed types, so that
both engines return the same schema.
"""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.calendar import covered_days
from tallyhouse.functions.keys import surrogate_key
from tallyhouse.functions.numbers import mean, money
from tallyhouse.functions.text import size_code, without_size
from tallyhouse.operators import constraints, intervals, joins, ordered, snapshot, staging
from tallyhouse.plans import cube, diagnostics, dimensions, facts, generate, intermediate, kpis, quality, rejects, reports
from tallyhouse.schemas import GOLD_TABLES
from tallyhouse.sources import audit, bronze, gold, landing
from workload.oracle import mean as o_mean
from workload.oracle import key, percent, rate, ratio, sql, total, zero
from workload.bound import OPENING_STOCK
from workload.scratch import scratch_folder

QUERIES = {}


def query(name, oracle=None, complete=False):
    """Register a query; `oracle` is the body of its SQL, or all of it when `complete`."""

    def register(build):
        assert name not in QUERIES, name
        QUERIES[name] = (build, oracle if oracle is None or complete else sql(oracle))
        return build

    return register


def broken_key(column, every, rest):
    """A key column of which one in `every` values points nowhere."""
    key = F.col(column)
    return F.when(key % every == rest, -key).otherwise(key).alias(column)


def columns_of(alias, names):
    return ", ".join(f"{alias}.{n}" for n in names)


# ---- staging -------------------------------------------------------------------------------------

query("stg_01_latest_snapshot", "select * from pos_latest")(lambda t: snapshot.latest_snapshot(t.b_pos))

query("stg_02_typed_pos", """
select transaction_id, store_id, product_id, transaction_date, transaction_time,
 cast(substr(transaction_time, 1, 2) as integer) transaction_hour, transaction_qty, unit_price,
 cast(transaction_qty * unit_price as decimal(20,2)) gross_revenue, trim(store_location) store_location,
 trim(product_category) product_category, trim(product_type) product_type, trim(product_detail) product_name_raw,
 ingestion_date from b_pos""")(lambda t: staging.type_pos(t.b_pos))

query("stg_03_null_rejection", """select * from b_pos where transaction_id is not null and transaction_date is not null
 and transaction_qty is not null and unit_price is not null""")(lambda t: staging.reject_nulls(t.b_pos))

query("stg_04_range_rejection", "select * from b_pos where transaction_qty > 0 and unit_price > 0")(
    lambda t: staging.reject_out_of_range(t.b_pos)
)

REASON = " ".join(f"when {broken} then '{name}'" for name, broken in staging.REJECTS.items())


@query("stg_04_reject_reasons", f"""select r.reject_reason, count(n.reject_reason) n_rows from (values ('kept'), {
    ', '.join(f"('{name}')" for name in staging.REJECTS)}) r(reject_reason)
 left join (select case {REASON} else 'kept' end reject_reason from pos_latest) n using (reject_reason) group by 1""")
def reject_reasons(t):
    """Lines by reason, counted in the scan that writes them; the kept ones are those that staging gives."""
    return rejects.write_lines(t.spark, t.b_pos, fresh(t, "lake"))


@query("stg_04_rejected_lines", f"""select transaction_id, product_id, transaction_date, transaction_qty, unit_price,
 case {REASON} end reject_reason from pos_latest where case {REASON} end is not null""")
def rejected(t):
    root = fresh(t, "lake")
    rejects.write_lines(t.spark, t.b_pos, root)
    return rejects.rejected_lines(t.spark, root).select(
        "transaction_id", "product_id", "transaction_date", "transaction_qty", "unit_price", "reject_reason"
    )


query("stg_05_canonical_names", """
select l.transaction_id, l.product_detail product_name_raw, coalesce(m.canonical_product_name, l.product_detail) product_name,
 m.size_code, coalesce(m.cost_required, true) cost_required, coalesce(m.recipe_required, true) recipe_required,
 coalesce(m.product_group, 'unclassified') product_group
from b_pos l left join stg_mapping m on l.product_detail = m.pos_product_detail""")(
    lambda t: joins.canonicalise(
        t.b_pos.select("transaction_id", F.col("product_detail").alias("product_name_raw")),
        staging.stage_mapping(t.b_mapping),
    )
)

query("stg_06_line_numbers", "select transaction_id, product_id, product_name_raw, transaction_line_number from stg_pos")(
    lambda t: t.stg_pos.select("transaction_id", "product_id", "product_name_raw", "transaction_line_number")
)

# Rows equal on all order columns are interchangeable, so columns outside the order may differ per number.
query("stg_07_pos_transactions", f"select {columns_of('s', staging.STAGED_POS)} from stg_pos s")(lambda t: t.stg_pos)
query("stg_08_product_costs", "select * from stg_costs")(lambda t: t.stg_costs)
query("stg_09_recipes_bom", "select * from stg_bom")(lambda t: t.stg_bom)
query("stg_10_daily_inventory", "select * from stg_inventory")(lambda t: t.stg_inventory)
query("stg_11_staff_shifts", "select * from stg_shifts")(lambda t: t.stg_shifts)
query("stg_12_promotions", """
select trim(promotion_id) promotion_id, trim(promotion_name) promotion_name, trim(discount_type) discount_type, discount_value,
 trim(applicable_category) applicable_category, start_date, end_date, trim(applicable_days) applicable_days,
 trim(applicable_hours) applicable_hours, trim(source_system) source_system from b_promotions""")(
    lambda t: staging.stage_promotions(t.b_promotions)
)

# ---- sources and sinks ---------------------------------------------------------------------------

RAW_NAMES = {
    "transaction_id": " Transaction ID", "transaction_date": "transaction_date", "transaction_time": "transaction_time",
    "transaction_qty": "transaction_qty", "store_id": "Store ID ", "store_location": "Store Location",
    "product_id": "product_id", "unit_price": "unit_price", "product_category": "product_category",
    "product_type": "product_type", "product_detail": "Product Detail",
}


def text_frame(df):
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def fresh(t, label):
    return f"{scratch_folder(t.spark)}/{label}-{uuid.uuid4().hex}"


@query("src_01_raw_csv_as_text", """
select transaction_id, cast(transaction_date as varchar) transaction_date, transaction_time,
 cast(transaction_qty as varchar) transaction_qty, cast(store_id as varchar) store_id, store_location,
 cast(product_id as varchar) product_id, cast(unit_price as varchar) unit_price, product_category, product_type,
 product_detail from b_pos""")
def raw_csv(t):
    folder = fresh(t, "raw")
    raw = t.b_pos.select(*[F.col(c).alias(h) for c, h in RAW_NAMES.items()])
    raw.write.option("header", True).csv(folder)
    return landing.load_raw_pos(t.spark, folder)


query("src_02_landing_report", """
select count(*) n_rows, cast(12 as integer) n_cols, '' missing_columns,
 cast(count(*) filter (where transaction_id is null) as bigint) null_keys,
 count(*) >= 100 and count(*) filter (where transaction_id is null) = 0 "valid" from b_pos""")(
    lambda t: landing.landing_report(t.b_pos)
)


@query("src_03_bronze_snapshots", """
select ingestion_date, count(*) n_rows, cast(sum(transaction_qty * unit_price) as decimal(24,2)) revenue,
 'pos.csv' source_file from b_pos group by 1""")
def bronze_snapshots(t):
    root = fresh(t, "bronze")
    name = "bronze_pos_transactions"
    for date in ("2023-06-14", "2023-06-15", "2023-06-14"):  # a rerun replaces its own arrival only
        rows = t.b_pos.where(F.col("ingestion_date") == date).drop("ingestion_date")
        bronze.write_bronze(rows, root, name, date, source_file="pos.csv")
    read = bronze.read_bronze(t.spark, root, name)
    typed = staging.type_pos(read.where("transaction_qty is not null"))
    sums = typed.groupBy("ingestion_date").agg(F.sum("gross_revenue").cast("decimal(24,2)").alias("revenue"))
    counts = read.groupBy("ingestion_date", "source_file").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(sums, "ingestion_date").select("ingestion_date", "n_rows", "revenue", "source_file")


@query("src_04_bronze_costs", "select * from b_costs")
def bronze_costs(t):
    root = fresh(t, "bronze")
    bronze.write_bronze(t.b_costs.drop("ingestion_date"), root, "bronze_product_costs", "2023-06-15")
    found = bronze.read_bronze(t.spark, root, "bronze_product_costs", latest=True)
    return found.select(*staging.cast_columns(dict(t.b_costs.drop("ingestion_date").dtypes)))


BRONZE_VIEWS = {
    "bronze_pos_transactions": "b_pos", "bronze_product_costs": "b_costs", "bronze_recipes_bom": "b_bom",
    "bronze_daily_inventory": "b_counts", "bronze_staff_shifts": "b_shifts", "bronze_promotions": "b_promotions",
}
@query("src_05_incremental_copy", " union all ".join(
    f"""select '{n}' dataset, ingestion_date, case when ingestion_date = '2023-06-14' then 'same' else 'copied' end status,
 count(*) n_rows from {v} group by 2""" if n != "bronze_promotions"
    else f"select '{n}' dataset, '2023-06-15' ingestion_date, 'copied' status, count(*) n_rows from {v}"
    for n, v in BRONZE_VIEWS.items()
))
def incremental_copy(t):
    """All six datasets, of which the older POS arrival is in the target already."""
    source, target = fresh(t, "source"), fresh(t, "target")
    for name in BRONZE_VIEWS:
        rows = t.bronze[name]
        dates = ("2023-06-14", "2023-06-15") if name == "bronze_pos_transactions" else ("2023-06-15",)
        for date in dates:
            own = rows.where(F.col("ingestion_date") == date).drop("ingestion_date") if "ingestion_date" in rows.columns else rows
            bronze.write_bronze(own, source, name, date)
    bronze.copy_report(t.spark, source, target, run_date="2023-06-14")
    report = bronze.copy_report(t.spark, source, target, full_refresh=True)
    # Every file has a header line.
    return report.groupBy("dataset", "ingestion_date", "status").agg((F.sum("n_rows") - F.count(F.lit(1))).alias("n_rows"))


query("src_06_arrival_status", " union all ".join(
    f"select '{n}' dataset, (select count(*) from {v}) > 0 arrived" for n, v in BRONZE_VIEWS.items()
))(lambda t: bronze.arrival_status({n: t.bronze[n] for n in BRONZE_VIEWS}))

query("src_09_row_counts", " union all ".join(
    f"select '{n}' table_name, (select count(*) from {v}) n_rows" for n, v in BRONZE_VIEWS.items()
))(lambda t: bronze.row_counts({n: t.bronze[n] for n in BRONZE_VIEWS}))

query("src_10_mapping_seed", "select * from stg_mapping")(lambda t: staging.stage_mapping(t.b_mapping))


@query("src_11_gold_parquet", "select * from fct_inventory_snapshot")
def gold_parquet(t):
    root = fresh(t, "lake")
    gold.write_table(t.fct_inventory_snapshot, root, "fct_inventory_snapshot")
    return gold.read_table(t.spark, root, "fct_inventory_snapshot")


@query("src_12_export_manifest", " union all ".join(
    f"""select '{n}' "table", (select count(*) from {n}) "rows" """ for n in GOLD_TABLES
))
def export_manifest(t):
    """All eight Gold tables, written, read back and compared by fingerprint."""
    folder = fresh(t, "export")
    gold.export_snapshot({n: t.full_gold[n] for n in GOLD_TABLES}, folder, snapshot_id="bi")
    manifest = t.spark.read.option("multiLine", True).json(f"{folder}/bi/manifest.json")
    return manifest.select(F.explode("tables").alias("t")).select("t.table", "t.rows")


@query("src_16_backlog_file", "select pos_product_detail, product_category, transactions, suggested_action from backlog")
def backlog_file(t):
    folder = fresh(t, "backlog")
    audit.write_backlog(t_backlog(t), folder)
    return t.spark.read.option("header", True).csv(folder).select(
        "pos_product_detail", "product_category", "transactions", "suggested_action"
    )


# ---- joins ---------------------------------------------------------------------------------------

query("jn_01_mapping_join", """select l.transaction_id, l.product_detail, m.canonical_product_name, m.size_code
 from b_pos l left join b_mapping m on trim(l.product_detail) = trim(m.pos_product_detail)""")(
    lambda t: joins.lookup_join(
        t.b_pos.select("transaction_id", F.trim("product_detail").alias("product_detail")),
        t.b_mapping.select(F.trim("pos_product_detail").alias("product_detail"), "canonical_product_name", "size_code"),
        ["product_detail"],
    )
)

query("jn_02_validity_join", """select l.transaction_id, l.product_name, l.transaction_date, c.unit_cost, c.valid_from, c.valid_to
 from lines l left join stg_costs c on l.product_name = c.product_name and l.transaction_date between c.valid_from and c.valid_to""")(
    lambda t: joins.join_valid(
        t.lines.select("transaction_id", "product_name", "transaction_date"),
        t.stg_costs.select("product_name", "unit_cost", "valid_from", "valid_to"),
    )
)

# Hundreds of versions per product, overlapping: the interval index gives the same rows as comparing all versions.
VERSIONS = """from lines l left join b_cost_versions c on l.product_name = c.product_name
 and l.transaction_date between c.valid_from and c.valid_to"""
VERSIONED_LINES = ("transaction_id", "product_id", "product_name", "transaction_date")
query("jn_02_interval_index", f"select l.transaction_id, l.product_id, l.product_name, l.transaction_date, c.unit_cost, "
      f"c.valid_from, c.valid_to {VERSIONS}")(
    lambda t: intervals.join_valid_indexed(t.lines.select(*VERSIONED_LINES), t.b_cost_versions)
)
# Each line once, with the version that started last.
query("jn_02_interval_latest", """select l.transaction_id, l.product_id, l.product_name, l.transaction_date, c.unit_cost,
 c.valid_from, c.valid_to from lines l left join (
 select d.product_name, d.transaction_date, max(c.valid_from) valid_from from (select distinct product_name, transaction_date from lines) d
 join b_cost_versions c on d.product_name = c.product_name and d.transaction_date between c.valid_from and c.valid_to group by 1, 2) b
 on l.product_name = b.product_name and l.transaction_date = b.transaction_date
 left join b_cost_versions c on b.product_name = c.product_name and b.valid_from = c.valid_from""")(
    lambda t: intervals.join_valid_indexed(t.lines.select(*VERSIONED_LINES), t.b_cost_versions, latest=True)
)
BOUNDARIES = """select product_name, b seg_from, lead(b) over (partition by product_name order by b) - 1 seg_to from (
 select product_name, valid_from b from b_cost_versions union select product_name, valid_to + 1 from b_cost_versions)"""
query("jn_02_interval_overlaps", f"""select s.product_name, s.seg_from, s.seg_to, count(*) n_versions from ({BOUNDARIES}) s
 join b_cost_versions c on s.product_name = c.product_name and c.valid_from <= s.seg_from and c.valid_to >= s.seg_to
 group by 1, 2, 3 having count(*) > 1""")(lambda t: intervals.overlaps(t.b_cost_versions, ["product_name"]))

query("jn_03_bom_explosion", """select u.transaction_date, u.store_id, u.product_name, u.total_qty_sold, b.ingredient_name,
 b.qty_required_per_unit from units u join stg_bom b on u.product_name = b.product_name""")(
    lambda t: joins.explode_bom(
        intermediate.units_by_product(t.lines),
        t.stg_bom.select("product_name", "ingredient_name", "qty_required_per_unit"),
    )
)

query("jn_04_labor_revenue", "select s.shift_date, s.store_id, s.total_labor_cost, r.daily_revenue from labor_totals s "
      "left join daily_revenue r on s.shift_date = r.transaction_date and s.store_id = r.store_id")(
    lambda t: t.labor.select("shift_date", "store_id", "total_labor_cost", "daily_revenue")
)

query("jn_05_product_costs", """select p.product_name, c.unit_cost, c.valid_from from pos_products p
 left join stg_costs c on p.product_name = c.product_name""")(
    lambda t: joins.lookup_join(
        dimensions.product_attributes(t.lines).select("product_name"),
        t.stg_costs.select("product_name", "unit_cost", "valid_from"),
        ["product_name"],
    )
)

query("jn_06_theoretical_actual", """select transaction_date, store_id, ingredient_name, theoretical_consumption, actual_consumed,
 waste_qty from waste""")(
    lambda t: facts.waste_measures(t.theoretical, t.stg_inventory).select(
        "transaction_date", "store_id", "ingredient_name", "theoretical_consumption", "actual_consumed", "waste_qty"
    )
)

query("jn_07_window_column", f"""select inventory_date, store_id, ingredient_name, closing_stock,
 {ratio('total7', 'n7', 6)} avg_daily_consumption_7d from coverage""")(
    lambda t: ordered.trailing_avg(
        t.stg_inventory, ["store_id", "ingredient_name"], "inventory_date", "actual_consumed", name="avg_daily_consumption_7d"
    ).select("inventory_date", "store_id", "ingredient_name", "closing_stock", "avg_daily_consumption_7d")
)

query("jn_08_key_lookup", """select l.transaction_id, l.product_id, d.date_key, s.store_key from lines l
 left join dim_date d on l.transaction_date = d.full_date left join dim_store s on l.store_id = s.store_id""")(
    lambda t: joins.lookup_keys(
        t.lines.select("transaction_id", "product_id", "transaction_date", "store_id"),
        [
            (t.dim_date, {"transaction_date": "full_date"}, "date_key"),
            (t.dim_store, {"store_id": "store_id"}, "store_key"),
        ],
    ).select("transaction_id", "product_id", "date_key", "store_key")
)

query("jn_09_star_join", """select f.labor_key, d.year_month, d.week_num, s.store_name from fct_labor f
 join dim_date d on f.date_key = d.date_key join dim_store s on f.store_key = s.store_key""")(
    lambda t: reports.star(
        t.fct_labor.select("labor_key", "date_key", "store_key"),
        date_key=t.dim_date.select("date_key", "year_month", "week_num"),
        store_key=t.dim_store.select("store_key", "store_name"),
    ).select("labor_key", "year_month", "week_num", "store_name")
)

query("jn_10_lines_without_cost", """select l.product_name, count(*) n_lines from lines l
 left join stg_costs c on l.product_name = c.product_name where c.product_name is null group by 1""")(
    lambda t: joins.missing_in(t.lines, t.stg_costs, {"product_name": "product_name"})
    .groupBy("product_name")
    .agg(F.count(F.lit(1)).alias("n_lines"))
)

query("jn_11_unmapped_names", """select distinct product_detail from b_pos
 where product_detail not in (select pos_product_detail from b_mapping)""")(
    lambda t: joins.missing_in(
        t.b_pos.select("product_detail").distinct(), t.b_mapping, {"product_detail": "pos_product_detail"}
    )
)

query("jn_12_existence_flags", """select distinct product_detail,
 product_detail in (select product_name from b_costs) has_cost, product_detail in (select product_name from b_bom) has_recipe
 from b_pos""")(
    lambda t: joins.lookup_join(
        joins.lookup_join(
            t.b_pos.select("product_detail").distinct(),
            t.b_costs.select(F.col("product_name").alias("product_detail")).distinct().withColumn("c", F.lit(True)),
            ["product_detail"],
        ),
        t.b_bom.select(F.col("product_name").alias("product_detail")).distinct().withColumn("r", F.lit(True)),
        ["product_detail"],
    ).select("product_detail", F.col("c").isNotNull().alias("has_cost"), F.col("r").isNotNull().alias("has_recipe"))
)

query("jn_13_one_row_cross", f"""select (select count(*) from pos_latest) bronze_rows, (select count(*) from lines) silver_rows,
 {percent('(select count(*) from lines)', '(select count(*) from pos_latest)')} pct_retained""")(
    lambda t: quality.silver_retention(t.bronze)
)

CONSECUTIVE = """
select t.store_id, t.ingredient_name, t.inventory_date, y.closing_stock previous_closing, t.opening_stock
from stg_inventory t left join stg_inventory y on t.store_id = y.store_id and t.ingredient_name = y.ingredient_name
and y.inventory_date = t.inventory_date - 1"""
query("jn_14_consecutive_days", CONSECUTIVE)(
    lambda t: t.stg_inventory.select("store_id", "ingredient_name", "inventory_date", "opening_stock").join(
        t.stg_inventory.select(
            "store_id",
            "ingredient_name",
            F.date_add("inventory_date", 1).alias("inventory_date"),
            F.col("closing_stock").alias("previous_closing"),
        ),
        ["store_id", "ingredient_name", "inventory_date"],
        "left",
    )
)

LAST_DAY = """
select l.store_id, cast(l.labor as decimal(20,2)) labor, cast(r.sales as decimal(20,2)) sales from
(select store_id, sum(labor_cost_usd) labor from b_shifts where shift_date = (select max(shift_date) from b_shifts) group by 1) l
left join (select store_id, sum(transaction_qty * unit_price) sales from pos_latest
 where transaction_date = (select max(shift_date) from b_shifts) group by 1) r using (store_id)"""
query("jn_15_last_day_labor", LAST_DAY)(
    lambda t: quality.last_day_labor(t.bronze).select(
        "store_id", F.col("labor").cast("decimal(20,2)").alias("labor"), F.col("sales").cast("decimal(20,2)").alias("sales")
    )
)

query("jn_16_expression_keys", """select p.product_detail, c.unit_cost from (select distinct product_detail from b_pos) p
 left join b_costs c on trim(p.product_detail) = trim(c.product_name)""")(
    lambda t: joins.lookup_join(
        t.b_pos.select("product_detail").distinct().withColumn("k", F.trim("product_detail")),
        t.b_costs.select(F.trim("product_name").alias("k"), "unit_cost"),
        ["k"],
    ).select("product_detail", "unit_cost")
)

query("jn_17_scalar_subquery", """select transaction_id, product_id, unit_price from b_pos
 where unit_price = (select max(unit_price) from b_pos)""")(
    lambda t: t.b_pos.where(F.col("unit_price") == t.b_pos.select(F.max("unit_price")).scalar()).select(
        "transaction_id", "product_id", "unit_price"
    )
)

# A fiftieth of the lines names an order nobody has; all orders are looked up.
query("jn_18_orphan_lines", """select l_orderkey, l_linenumber, l_partkey from (
 select case when l_orderkey % 50 = 7 then -l_orderkey else l_orderkey end l_orderkey, l_linenumber, l_partkey from lineitem) l
 where not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey)""")(
    lambda t: joins.missing_in(
        t.table("lineitem").select(broken_key("l_orderkey", 50, 7), "l_linenumber", "l_partkey"),
        t.table("orders"),
        {"l_orderkey": "o_orderkey"},
    )
)

# ---- aggregations --------------------------------------------------------------------------------

query("ag_01_labor_totals", "select * from labor_totals")(lambda t: intermediate.labor_totals(t.stg_shifts))
query("ag_02_daily_revenue", "select * from daily_revenue")(lambda t: intermediate.daily_revenue(t.lines))
query("ag_03_units_by_product", "select * from units")(lambda t: intermediate.units_by_product(t.lines))
query("ag_04_theoretical_use", """select transaction_date, store_id, ingredient_name, theoretical_consumption from theoretical""")(
    lambda t: t.theoretical.select("transaction_date", "store_id", "ingredient_name", "theoretical_consumption")
)
query("ag_05_product_attributes", "select * from pos_products")(lambda t: dimensions.product_attributes(t.lines))
query("ag_06_distinct_members", """select 'store' kind, cast(store_id as varchar) member from (select distinct store_id from lines)
 union all select 'ingredient', ingredient_name from (select distinct ingredient_name from stg_bom)""")(
    lambda t: t.lines.select(F.lit("store").alias("kind"), F.col("store_id").cast("string").alias("member"))
    .distinct()
    .unionByName(t.stg_bom.select(F.lit("ingredient").alias("kind"), F.col("ingredient_name").alias("member")).distinct())
)
query("ag_07_snapshot_counts", """select ingestion_date, count(*) row_count, count(distinct store_id) store_count,
 case when count(*) < 300 then 'LOW' else 'PASS' end status from pos_latest group by 1""")(
    lambda t: snapshot.latest_snapshot(t.b_pos)
    .groupBy("ingestion_date")
    .agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("store_id").alias("store_count"))
    .withColumn("status", F.when(F.col("row_count") < 300, "LOW").otherwise("PASS"))
)
query("ag_08_global_having", """select count(*) invalid_count, cast(min(transaction_qty) as integer) min_value
 from b_pos where transaction_qty <= 0 having count(*) > 0""")(
    lambda t: t.b_pos.where("transaction_qty <= 0")
    .agg(F.count(F.lit(1)).alias("invalid_count"), F.min("transaction_qty").alias("min_value"))
    .where("invalid_count > 0")
)
query("ag_09_filtered_max", """select max(inventory_date) today_date,
 max(inventory_date) filter (where inventory_date < (select max(inventory_date) from stg_inventory)) yesterday_date
 from stg_inventory""")(
    lambda t: t.stg_inventory.agg(
        F.max("inventory_date").alias("today_date"),
        F.max(
            F.when(
                F.col("inventory_date") < t.stg_inventory.select(F.max("inventory_date")).scalar(), F.col("inventory_date")
            )
        ).alias("yesterday_date"),
    )
)
query("ag_10_grouped_counts", """select store_id, store_location, count(*) transaction_count from pos_latest
 where store_id not in (3, 5) group by 1, 2 having count(*) > 0""")(
    lambda t: snapshot.latest_snapshot(t.b_pos)
    .where(~F.col("store_id").isin(3, 5))
    .groupBy("store_id", "store_location")
    .agg(F.count(F.lit(1)).alias("transaction_count"))
)
query("ag_11_two_distinct_counts", """select store_id, count(distinct transaction_id) transactions,
 count(distinct product_name) products from lines group by 1""")(
    lambda t: t.lines.groupBy("store_id").agg(
        F.countDistinct("transaction_id").alias("transactions"), F.countDistinct("product_name").alias("products")
    )
)
query("ag_12_group_by_missing", """select l.product_name, count(*) n_lines, c.unit_cost from lines l
 left join stg_costs c on l.product_name = c.product_name group by 1, 3 having c.unit_cost is null""")(
    lambda t: joins.lookup_join(
        t.lines.groupBy("product_name").agg(F.count(F.lit(1)).alias("n_lines")),
        t.stg_costs.select("product_name", "unit_cost"),
        ["product_name"],
    ).where("unit_cost is null")
)
query("ag_13_conditional_count", """select store_id, count(case when labor_status = 'OVER TARGET' then 1 end) days_over_target
 from fct_labor group by 1""")(
    lambda t: t.fct_labor.groupBy("store_id").agg(
        F.count_if(F.col("labor_status") == "OVER TARGET").alias("days_over_target")
    )
)
query("ag_14_mixed_rollup", f"""select store_id, cast(sum(waste_amount_usd) as decimal(24,4)) waste_usd,
 {o_mean('waste_rate_pct')} avg_waste_rate_pct, max(waste_rate_pct) max_waste_rate_pct from fct_waste group by 1""")(
    lambda t: t.fct_waste.groupBy("store_id").agg(
        money(F.sum("waste_amount_usd"), 4, 24).alias("waste_usd"),
        mean("waste_rate_pct").alias("avg_waste_rate_pct"),
        F.max("waste_rate_pct").alias("max_waste_rate_pct"),
    )
)
query("ag_15_product_counts", """select trim(product_detail) pos_product_detail, trim(product_category) product_category,
 count(*) transactions from b_pos group by 1, 2""")(
    lambda t: t.b_pos.groupBy(
        F.trim("product_detail").alias("pos_product_detail"), F.trim("product_category").alias("product_category")
    ).agg(F.count(F.lit(1)).alias("transactions"))
)
query("ag_16_backlog_actions", "select suggested_action, count(*) n_products from backlog group by 1")(
    lambda t: diagnostics.backlog_summary(t_backlog(t))
)
query("ag_17_last_day_sums", LAST_DAY.replace("select l.store_id,", "select l.store_id store,"))(
    lambda t: quality.last_day_labor(t.bronze).select(
        F.col("store_id").alias("store"),
        F.col("labor").cast("decimal(20,2)").alias("labor"),
        F.col("sales").cast("decimal(20,2)").alias("sales"),
    )
)

# ---- windows -------------------------------------------------------------------------------------

query("win_01_row_number", """select l_orderkey, l_partkey, cast(row_number() over
 (partition by l_orderkey order by l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice) as bigint) line_number
 from lineitem""")(
    lambda t: ordered.number_lines(
        t.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"),
        ["l_orderkey"],
        ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"],
        name="line_number",
    ).select("l_orderkey", "l_partkey", "line_number")
)
# The same numbers with every transaction above four lines treated as too large for one task.
query("win_01_row_number_split", """select transaction_id, product_id, product_name_raw, transaction_line_number from stg_pos""")(
    lambda t: staging.number_pos(t.silver_lines, max_group_rows=4).select(
        "transaction_id", "product_id", "product_name_raw", "transaction_line_number"
    )
)
query("win_02_trailing_mean", f"""select store_id, ingredient_name, inventory_date, cast(n7 as bigint) n_records,
 cast(total7 as decimal(22,2)) consumed, {ratio('total7', 'n7', 6)} avg_consumption from coverage""")(
    lambda t: ordered.trailing_avg(
        t.stg_inventory, ["store_id", "ingredient_name"], "inventory_date", "actual_consumed", 7,
        name="avg_consumption", total="consumed", count="n_records",
    ).select(
        "store_id", "ingredient_name", "inventory_date", "n_records",
        F.col("consumed").cast("decimal(22,2)").alias("consumed"), "avg_consumption",
    )
)
query("win_03_roll_forward", """select store_id, ingredient_name, inventory_date, cast(opening_stock as decimal(24,2)) opening_stock,
 cast(closing_stock as decimal(24,2)) closing_stock from b_inventory""")(
    lambda t: t.b_inventory.select("store_id", "ingredient_name", "inventory_date", "opening_stock", "closing_stock")
)
@query("win_03_roll_forward_carried", """select store_id, ingredient_name, inventory_date,
 cast(opening_stock as decimal(24,2)) opening_stock, cast(closing_stock as decimal(24,2)) closing_stock from b_inventory""")
def roll_forward_carried(t):
    """The movements in two runs: the second goes on from the stored closings of the first."""
    keys, moves = ["store_id", "ingredient_name"], ("units_received", "actual_consumed")
    split = F.col("inventory_date") <= F.lit("2023-03-31").cast("date")
    first = t.stored(ordered.carry_forward(t.b_movements.where(split), keys, "inventory_date", OPENING_STOCK, *moves), "stock")
    last = ordered.closings(first, keys, "inventory_date")
    # Days settled before may arrive again: they are left out.
    second = ordered.carry_forward(t.b_movements, keys, "inventory_date", OPENING_STOCK, *moves, last=last, block_days=10)
    return first.unionByName(second).select(*keys, "inventory_date", "opening_stock", "closing_stock")


GROWTH = f"""
select year_month, revenue, lag(revenue) over (order by year_month) previous_revenue,
 {ratio('(revenue - lag(revenue) over (order by year_month)) * 100', 'lag(revenue) over (order by year_month)', 2)} mom_growth_pct
from (select strftime(transaction_date, '%Y-%m') year_month, cast(sum(gross_revenue) as decimal(24,2)) revenue from lines group by 1)"""
query("win_04_period_growth", GROWTH)(
    lambda t: ordered.period_growth(
        t.lines.groupBy(F.date_format("transaction_date", "yyyy-MM").alias("year_month")).agg(
            money(F.sum("gross_revenue"), 2, 24).alias("revenue")
        ),
        "year_month", "revenue", name="mom_growth_pct",
    ).withColumnRenamed("previous", "previous_revenue")
)
query("win_05_rank", """select l_partkey, quantity, cast(rank() over (order by quantity desc) as bigint) quantity_rank
 from (select l_partkey, cast(sum(cast(l_quantity as decimal(12,2))) as decimal(22,2)) quantity from lineitem group by 1)""")(
    lambda t: ordered.rank_by(
        t.table("lineitem").groupBy("l_partkey").agg(
            F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("decimal(22,2)").alias("quantity")
        ),
        "quantity",
        name="quantity_rank",
    )
)

# ---- sorts, limits, unions -----------------------------------------------------------------------

query("st_01_top_margins", """select product_name, avg_margin_pct from margins
 order by avg_margin_pct desc nulls last, product_name, product_category, margin_tier limit 10""")(
    lambda t: reports.top_margin_products(t.gold).select("product_name", "avg_margin_pct")
)
query("st_02_by_waste", "select * from weekly_waste order by waste_usd desc")(lambda t: reports.weekly_waste_by_store(t.gold))
query("st_03_three_keys", """select year_month, week_num, store_location, days_over_target from labor_trend order by 1, 2, 3""")(
    lambda t: reports.labor_efficiency_trend(t.gold).select("year_month", "week_num", "store_location", "days_over_target")
)
query("st_04_violations", "select * from cost_gaps order by transactions_today desc")(
    lambda t: quality.gate_cost_coverage(t.bronze).orderBy(F.desc("transactions_today"), "product_name")
)
query("st_05_backlog_head", """select pos_product_detail, product_category, transactions from backlog
 order by cast(transactions as bigint) desc, pos_product_detail, product_category limit 10""")(
    lambda t: t_backlog(t)
    .orderBy(F.col("transactions").cast("bigint").desc(), "pos_product_detail", "product_category")
    .limit(10)
    .select("pos_product_detail", "product_category", "transactions")
)
query("st_06_first_violations", "select * from cost_gaps order by transactions_today desc, product_name limit 3")(
    lambda t: quality.gate_cost_coverage(t.bronze).orderBy(F.desc("transactions_today"), "product_name").limit(3)
)
query("set_01_source_checks", " union all ".join(
    f"""select '{n}' source_name, count(*) row_count, max(ingestion_date) last_ingestion, case when count(*) = 0 then '{m}'
 else 'PASS' end status from {v} where ingestion_date = (select max(ingestion_date) from {v})"""
    for (n, m), v in zip(quality.REQUIRED_SOURCES, ("b_pos", "b_counts", "b_shifts"), strict=True)
))(lambda t: quality.source_arrivals(t.bronze))
query("set_02_value_checks", """
select 'unit_price' field_name, count(*) n_low from pos_latest where unit_price < 1000 having count(*) > 0
union all select 'transaction_qty', count(*) from pos_latest where transaction_qty < 10 having count(*) > 0""")(
    lambda t: snapshot.latest_snapshot(t.b_pos).where("unit_price < 1000")
    .agg(F.lit("unit_price").alias("field_name"), F.count(F.lit(1)).alias("n_low")).where("n_low > 0")
    .unionByName(
        snapshot.latest_snapshot(t.b_pos).where("transaction_qty < 10")
        .agg(F.lit("transaction_qty").alias("field_name"), F.count(F.lit(1)).alias("n_low")).where("n_low > 0")
    )
)

# ---- scalar functions ----------------------------------------------------------------------------

query("fn_text", """select product_detail, trim(regexp_replace(product_detail, ' +(Sm|Rg|Lg)$', '')) base_name,
 nullif(regexp_extract(product_detail, ' +(Sm|Rg|Lg)$', 1), '') size_code, substr(transaction_time, 1, 2) hour_text,
 lower(cast(transaction_qty > 10 as varchar)) large from b_pos""")(
    lambda t: t.b_pos.select(
        "product_detail",
        without_size(F.col("product_detail")).alias("base_name"),
        size_code(F.col("product_detail")).alias("size_code"),
        F.substring("transaction_time", 1, 2).alias("hour_text"),
        F.lower((F.col("transaction_qty") > 10).cast("string")).alias("large"),
    )
)
query("fn_calendar", """select distinct cast(strftime(d, '%Y%m%d') as integer) date_key, d full_date,
 cast(year(d) as integer) "year", cast(month(d) as integer) month_num, monthname(d) month_name,
 cast(quarter(d) as integer) "quarter", cast(week(d) as integer) week_num, cast(day(d) as integer) day_of_month,
 cast(isodow(d) as integer) day_of_week_num, dayname(d) day_of_week_name, isodow(d) in (6, 7) is_weekend,
 strftime(d, '%Y-%m') year_month from (select cast(o_orderdate as date) d from orders)""")(
    lambda t: dimensions.calendar_of(t.table("orders").select(F.col("o_orderdate").cast("date").alias("full_date")).distinct())
)
query("fn_surrogate_key", f"select transaction_id, {key('transaction_id', 'transaction_qty', 'store_id')} row_key from b_pos")(
    lambda t: t.b_pos.select(
        "transaction_id", surrogate_key("transaction_id", "transaction_qty", "store_id").alias("row_key")
    )
)
query("fn_null_safe_math", f"""select transaction_id, {ratio('unit_price', 'transaction_qty', 2)} per_unit,
 cast(abs(coalesce(transaction_qty, 0) - 25) as integer) distance,
 cast(case when transaction_qty is null then null else least(transaction_qty, 10) end as integer) at_most_ten,
 case when transaction_qty between 1 and 10 then 'few' when transaction_qty in (20, 30) then 'round' else 'other' end size_class
 from b_pos""")(
    lambda t: t.b_pos.select(
        "transaction_id",
        F.round(F.col("unit_price") / F.nullif(F.col("transaction_qty"), F.lit(0)), 2).cast("decimal(18,2)").alias("per_unit"),
        F.abs(F.coalesce("transaction_qty", F.lit(0)) - 25).alias("distance"),
        F.when(F.col("transaction_qty").isNotNull(), F.least("transaction_qty", F.lit(10))).alias("at_most_ten"),
        F.when(F.col("transaction_qty").between(1, 10), "few")
        .when(F.col("transaction_qty").isin(20, 30), "round")
        .otherwise("other")
        .alias("size_class"),
    )
)

# ---- intermediate, dimensions, facts -------------------------------------------------------------

query("int_01_sales_with_costs", "select * from int_sales")(lambda t: t.int_sales)
query("int_02_theoretical_consumption", "select * from theoretical")(lambda t: t.theoretical)
query("int_03_labor_by_day", "select * from int_labor")(lambda t: t.labor)
# The calendar of the days the lines cover, so that the query reads its range from the data.
query("dim_01_date", "select d.* from dim_date d where full_date between (select min(transaction_date) from b_pos) "
      "and (select max(transaction_date) from b_pos)")(
    lambda t: dimensions.calendar_of(covered_days(t.b_pos, "transaction_date"))
)
query("dim_02_store", "select * from dim_store")(lambda t: dimensions.build_dim_store(t.lines))
query("dim_03_product", "select * from dim_product")(
    lambda t: dimensions.build_dim_product(t.lines, t.stg_costs)
)
query("dim_03_product_versions", f"""select {key('p.product_name', 'v.seg_from')} version_key, p.*, v.unit_cost, v.seg_from valid_from,
 v.seg_to valid_to from pos_products p left join (
 select s.product_name, s.seg_from, s.seg_to, arg_max(c.unit_cost, c.valid_from) unit_cost from ({BOUNDARIES}) s
 join b_cost_versions c on s.product_name = c.product_name and c.valid_from <= s.seg_from and c.valid_to >= s.seg_to
 group by 1, 2, 3) v on p.product_name = v.product_name""")(
    lambda t: dimensions.build_dim_product_versions(t.lines, t.b_cost_versions)
)
query("dim_04_ingredient", "select * from dim_ingredient")(lambda t: t.dim_ingredient)
query("fct_01_sales", "select * from fct_sales")(lambda t: t.fct_sales)
query("fct_02_waste", "select * from fct_waste")(lambda t: t.fct_waste)
query("fct_03_labor", "select * from fct_labor")(lambda t: t.fct_labor)
query("fct_04_inventory_snapshot", "select * from fct_inventory_snapshot")(lambda t: t.fct_inventory_snapshot)

# Stored facts of an earlier state of the inputs, brought up to date day by day.
for label, fact in (("01_sales", "fct_sales"), ("02_waste", "fct_waste"), ("03_labor", "fct_labor"),
                    ("04_inventory", "fct_inventory_snapshot")):
    query(f"fct_{label}_rebuilt", f"select * from {fact}")(lambda t, fact=fact: t.rebuilt(fact))

# ---- quality gates -------------------------------------------------------------------------------

query("dq_01_row_count", """select ingestion_date, count(*) row_count, count(distinct store_id) store_count,
 'CRITICAL: missing data for one or more stores' status from pos_latest group by 1
 having count(*) >= 300 and count(distinct store_id) < 4""")(lambda t: quality.gate_row_count(t.bronze, min_stores=4))
query("dq_02_sources_arrived", """select 'bronze_staff_shifts' source_name, cast(0 as bigint) row_count,
 cast(null as varchar) last_ingestion, 'CRITICAL: staff shifts data not found' status
 where (select count(*) from b_pos) > 0 and (select count(*) from b_counts) > 0""")(
    lambda t: quality.gate_sources_arrived(t.bronze | {"bronze_staff_shifts": t.b_shifts.where("store_id is null")})
)
query("dq_03_negative_values", """select 'transaction_qty' field_name, count(*) invalid_count,
 cast(min(transaction_qty) as double) min_value, 'CRITICAL: negative or zero transaction_qty found' status
 from pos_latest where transaction_qty <= 0 having count(*) > 0
 union all select 'unit_price', count(*), cast(min(unit_price) as double), 'CRITICAL: negative or zero unit_price found'
 from pos_latest where unit_price <= 0 having count(*) > 0""")(lambda t: quality.gate_negative_values(t.bronze))
query("dq_04_known_stores", """select store_id, store_location, count(*) transaction_count, 'WARNING: unknown store_id' status
 from pos_latest where store_id not in (3, 5) group by 1, 2""")(
    lambda t: quality.gate_known_stores(t.bronze, stores=(3, 5))
)
query("dq_05_cost_coverage", "select * from cost_gaps")(lambda t: quality.gate_cost_coverage(t.bronze))
INVENTORY_GAPS = """
select store_id, ingredient_name, yesterday_closing, today_opening, abs(today_opening - coalesce(yesterday_closing, 0)) discrepancy,
 case when yesterday_closing is null then 'WARNING: no inventory record for yesterday'
 else 'WARNING: inventory gap > 5 units between days' end status
from (select t.store_id, t.ingredient_name, cast(y.closing_stock as double) yesterday_closing,
 cast(t.opening_stock as double) today_opening
 from (select * from b_counts where inventory_date = (select max(inventory_date) from b_counts)) t
 left join (select * from b_counts where inventory_date = (select max(inventory_date) from b_counts
 where inventory_date < (select max(inventory_date) from b_counts))) y
 on t.store_id = y.store_id and t.ingredient_name = y.ingredient_name)
where yesterday_closing is null or abs(today_opening - yesterday_closing) > 5"""
query("dq_06_inventory_continuity", INVENTORY_GAPS)(
    lambda t: quality.gate_inventory_continuity(t.bronze)
)
query("dq_07_labor_ratio", f"""select store_id, labor labor_cost, sales revenue, {percent('labor', 'sales')} labor_pct,
 case when sales is null then 'WARNING: no revenue data for this store' else 'INFO: labor % above 5 - verify data' end status
 from ({LAST_DAY}) where sales is null or (sales <> 0 and labor * 100 > sales * 5)""")(
    lambda t: quality.gate_labor_ratio(t.bronze, max_pct=5)
)
query("dq_08_silver_parity", f"""select b bronze_rows, s silver_rows, {percent('s', 'b')} pct_retained,
 'CRITICAL: silver retained less than 100% of bronze rows' status
 from (select (select count(*) from pos_latest) b, (select count(*) from lines) s) where s < b""")(
    lambda t: quality.gate_silver_parity(t.bronze, min_share="1.00")
)
GATE_COUNTS = {
    "01_row_count": "select count(*) from (select count(*) n, count(distinct store_id) s from pos_latest) where n < 300 or s < 3",
    "02_all_sources": "select count(*) where (select count(*) from b_pos) * (select count(*) from b_counts) * (select count(*) from b_shifts) = 0",
    "03_negative_values": """select (case when exists (select 1 from pos_latest where transaction_qty <= 0) then 1 else 0 end)
 + (case when exists (select 1 from pos_latest where unit_price <= 0) then 1 else 0 end)""",
    "04_referential": "select count(*) from (select distinct store_id, store_location from pos_latest where store_id not in (3, 5, 8))",
    "05_cost_coverage": "select count(*) from cost_gaps",
    "06_inventory": f"select count(*) from ({INVENTORY_GAPS})",
    "07_labor_ratio": f"select count(*) from ({LAST_DAY}) where sales is null or sales <> 0 and labor * 100 > sales * 60",
    "08_silver_parity": """select count(*) from (select (select count(*) from pos_latest) b, (select count(*) from lines) s)
 where b > 0 and s < b * 0.99""",
}
query("dq_09_gate_runner", " union all ".join(
    f"""select '{g}' gate, '{quality.GATES[g].level}' "level", case when n = 0 then 'PASS' else 'FAIL' end status,
 cast(n as bigint) n_failures from (select ({q}) n)""" for g, q in GATE_COUNTS.items()
))(lambda t: quality.gate_results(t.spark, t.bronze, quality.expand_blocks()[0]))


@query("dq_10_gate_report")
def gate_report(t):
    """All gates with their samples, stored results included; no SQL equivalent for the JSON samples."""
    store = audit.gate_store(fresh(t, "gates"))
    tables = {n: t.bronze[n] for n in t.bronze}
    try:
        return quality.run_gates(t.spark, tables, run_date="2023-06-15", store=store)[0]
    except quality.CriticalGateFailure as stop:
        return stop.results


# ---- constraint tests ----------------------------------------------------------------------------

query("ct_01_unique", """select l_orderkey, count(*) n_records from lineitem where l_orderkey is not null group by 1
 having count(*) > 1""")(lambda t: constraints.unique(t.table("lineitem"), "l_orderkey"))
query("ct_02_not_null", "select transaction_id, product_id, transaction_qty from b_pos where transaction_qty is null")(
    lambda t: constraints.not_null(t.b_pos.select("transaction_id", "product_id", "transaction_qty"), "transaction_qty")
)
query("ct_03_relationships", """select l_orderkey, l_partkey from (
 select l_orderkey, case when l_partkey % 40 = 3 then -l_partkey else l_partkey end l_partkey from lineitem) l
 where l_partkey is not null and not exists (select 1 from part p where p.p_partkey = l.l_partkey)""")(
    lambda t: constraints.relationships(
        t.table("lineitem").select("l_orderkey", broken_key("l_partkey", 40, 3)), "l_partkey", t.table("part"), "p_partkey"
    )
)
query("ct_04_accepted_values", """select stockout_risk_flag, count(*) n_records from fct_inventory_snapshot
 where stockout_risk_flag not in ('HIGH', 'MEDIUM') group by 1""")(
    lambda t: constraints.accepted_values(t.fct_inventory_snapshot, "stockout_risk_flag", ["HIGH", "MEDIUM"])
)
query("ct_05_accepted_range", """select waste_key, waste_rate_pct from fct_waste where waste_rate_pct < -50 or waste_rate_pct > 50""")(
    lambda t: constraints.accepted_range(t.fct_waste.select("waste_key", "waste_rate_pct"), "waste_rate_pct", -50, 50)
)


def violations_sql(test):
    table, column, check, arguments = test
    where = {
        "unique": f"select count(*) from (select {column} from {table} where {column} is not null group by 1 having count(*) > 1)",
        "not_null": f"select count(*) from {table} where {column} is null",
        "relationships": "select count(*) from {t} where {c} is not null and {c} not in (select {f} from {p} where {f} is not null)"
        .format(t=table, c=column, f=arguments.get("field"), p=arguments.get("parent")),
        "accepted_values": f"select count(*) from {table} where {column} not in ("
        + ", ".join(repr(v) for v in arguments.get("values", [0])) + ")",
        "accepted_range": f"select count(*) from {table} where {column} < {arguments.get('low', '-1e18')} "
        f"or {column} > {arguments.get('high', '1e18')}",
    }[check]
    return f"select '{table}' table_name, '{column}' column_name, '{check}' test, ({where}) violations"


@query("ct_all_gold_tests", " union all ".join(violations_sql(c) for c in constraints.GOLD_TESTS))
def all_gold_tests(t):
    """Facts are read by several tests: they are stored with the columns that the tests look at."""
    for name in (n for n in GOLD_TABLES if n.startswith("fct_")):
        t.full_gold[name] = t.stored(t.full_gold[name].select(*constraints.tested_columns(name)), name)
    return constraints.constraint_report(t.full_gold)

# ---- diagnostics, reports ------------------------------------------------------------------------


def t_backlog(t):
    return diagnostics.mapping_backlog(t.b_pos, t.b_mapping, t.b_costs, t.b_bom, no_recipe=("ECONOMY", "PROMO"))


# Counts per product first; then the products no cost names, and the number of ingredients of those a recipe names.
query("dg_01_products_without_cost", """select product_detail product_name, n_lines transactions, cast(null as decimal(10,4)) unit_cost,
 'NO COST - map or extend synthetic catalog' status from sold_products
where not exists (select 1 from b_costs where trim(b_costs.product_name) = trim(sold_products.product_detail))""")(
    lambda t: diagnostics.products_without_cost(t.b_pos, t.b_costs)
)
query("dg_02_recipe_coverage", """select product_detail product_name, n_orders transactions, coalesce(n_parts, 0) ingredients_in_recipe,
 if(n_parts > 0, 'OK', 'NO RECIPE - map or extend synthetic catalog') status
from sold_products left join recipe_parts on dish = trim(product_detail)""")(
    lambda t: diagnostics.recipe_coverage(t.b_pos, t.b_bom)
)
query("dg_03_mapping_backlog", "select * from backlog")(lambda t: diagnostics.order_backlog(t_backlog(t)))
query("dg_04_backlog_summary", "select suggested_action, count(*) n_products from backlog group by 1 order by 2 desc, 1")(
    lambda t: diagnostics.backlog_summary(t_backlog(t))
)
query("rpt_01_top_margin_products", """select * from margins
 order by avg_margin_pct desc nulls last, product_name, product_category, margin_tier limit 10""")(
    lambda t: reports.top_margin_products(t.gold)
)
query("rpt_02_labor_efficiency_trend", "select * from labor_trend")(lambda t: reports.labor_efficiency_trend(t.gold))
query("rpt_03_weekly_waste_by_store", "select * from weekly_waste")(lambda t: reports.weekly_waste_by_store(t.gold))

# ---- KPIs ----------------------------------------------------------------------------------------

GM = rate("sum(gross_profit)", "sum(gross_revenue)")
WASTE = f"""{total('waste_amount_usd', 4)} waste_amount, {total('waste_qty', 4)} waste_qty,
 {rate('abs(sum(waste_qty))', 'sum(theoretical_consumption)')} waste_rate"""
LABOR_RATE = rate("sum(total_labor_cost)", "sum(daily_revenue)")
DAYS = f"{ratio('sum(days_of_inventory_remaining)', 'count(days_of_inventory_remaining)', 2)}"
LAST = "snapshot_date = (select max(snapshot_date) from fct_inventory_snapshot)"

query("kpi_01_sales_totals", f"""select {total('gross_revenue')} revenue, {total('gross_profit')} gross_profit,
 {GM} gross_margin_rate from fct_sales""")(lambda t: kpis.sales_totals(t.gold))
query("kpi_02_last_month", f"select * from ({GROWTH}) order by year_month desc limit 1")(lambda t: kpis.last_month(t.gold))
query("kpi_02_monthly_growth", GROWTH)(lambda t: kpis.revenue_growth(t.gold))
query("kpi_03_order_value", f"""select count(distinct transaction_id) orders, {total('gross_revenue')} revenue,
 {rate('sum(gross_revenue)', 'count(distinct transaction_id)', 2)} average_order_value from fct_sales""")(
    lambda t: kpis.order_value(t.gold)
)
query("kpi_04_labor_share", f"""select labor_cost, labor_revenue, labor_cost_rate,
 case when labor_cost_rate * 100 > 35 then 'OVER TARGET' when labor_cost_rate * 100 > 30 then 'WATCH' else 'ON TARGET' end
 labor_cost_status from (select {total('total_labor_cost')} labor_cost, {total('daily_revenue')} labor_revenue,
 {LABOR_RATE} labor_cost_rate from fct_labor)""")(lambda t: kpis.labor_share(t.gold))
query("kpi_05_waste_totals", f"select {WASTE} from fct_waste")(lambda t: kpis.waste_totals(t.gold))
query("kpi_06_revenue_per_labor_hour", f"""select {total('daily_revenue')} labor_revenue, {total('total_hours_worked', 1)} hours_worked,
 {rate('sum(daily_revenue)', 'sum(total_hours_worked)', 2)} revenue_per_labor_hour from fct_labor""")(
    lambda t: kpis.revenue_per_labor_hour(t.gold)
)
query("kpi_07_stockouts", f"""select max(snapshot_date) snapshot_date, count(*) filter (where stockout_risk_flag = 'HIGH')
 stockout_high_count from fct_inventory_snapshot where {LAST}""")(lambda t: kpis.stockouts(t.gold))
query("kpi_07_stockouts_by_store", f"""select s.store_name, count(*) filter (where f.stockout_risk_flag = 'HIGH') stockout_high_count
 from fct_inventory_snapshot f join dim_store s using (store_key) where {LAST} group by 1""")(
    lambda t: kpis.stockouts_by_store(t.gold)
)
query("kpi_08_inventory_totals", f"""select {DAYS} avg_days_inventory, {total('units_received')} units_received,
 (select {total('closing_stock')} from fct_inventory_snapshot where {LAST}) closing_stock from fct_inventory_snapshot""")(
    lambda t: kpis.inventory_totals(t.gold)
)
for label, column, relation in (
    ("month", "year_month", "dim_date using (date_key)"),
    ("weekday", "day_of_week_name", "dim_date using (date_key)"),
    ("category", "product_category", "dim_product using (product_key)"),
    ("store", "store_name", "dim_store using (store_key)"),
):
    query(f"kpi_09_revenue_by_{label}", f"""select d.{column}, cast(sum(f.gross_revenue) as decimal(24,2)) revenue
 from fct_sales f join {relation.split()[0]} d {relation.split(' ', 1)[1]} group by 1""")(
        lambda t, column=column: kpis.revenue_by(t.gold, column)
    )
query("kpi_10_product_table", f"""select *, rank() over (order by revenue desc) revenue_rank from (
 select product_name, {total('gross_revenue')} revenue, {GM} gross_margin_rate from fct_sales group by 1)""")(
    lambda t: kpis.product_table(t.gold)
)
query("kpi_11_labor_by_month", f"""select d.year_month, {total('daily_revenue')} revenue, {LABOR_RATE} labor_cost_rate
 from fct_labor join dim_date d using (date_key) group by 1""")(lambda t: kpis.labor_by_month(t.gold))
query("kpi_11_waste_by_month", f"select d.year_month, {WASTE} from fct_waste join dim_date d using (date_key) group by 1")(
    lambda t: kpis.waste_by_month(t.gold)
)
query("kpi_11_waste_by_ingredient", f"select ingredient_name, {WASTE} from fct_waste group by 1")(
    lambda t: kpis.waste_by_ingredient(t.gold)
)
query("kpi_12_last_day_inventory", f"""select s.store_name, f.ingredient_name, f.snapshot_date, f.closing_stock,
 f.days_of_inventory_remaining, f.stockout_risk_flag from fct_inventory_snapshot f join dim_store s using (store_key) where {LAST}""")(
    lambda t: kpis.last_day_inventory(t.gold)
)
query("kpi_12_days_trend", f"select snapshot_date, {DAYS} avg_days_inventory from fct_inventory_snapshot group by 1")(
    lambda t: kpis.days_inventory_trend(t.gold)
)
MATRIX = ", ".join(
    ratio(f"sum(case when store_name = '{s}' then days_of_inventory_remaining end)",
          f"count(case when store_name = '{s}' then days_of_inventory_remaining end)", 2) + f' "{s}"'
    for s in ("Astoria", "Lower Manhattan", "Hell''s Kitchen")
).replace('"Hell\'\'s', '"Hell\'s')
query("kpi_13_coverage_matrix", f"select ingredient_name, {MATRIX} from fct_inventory_snapshot join dim_store using (store_key) group by 1")(
    lambda t: kpis.coverage_matrix(t.gold)
)
query("kpi_14_sliced_sales", f"""select {total('gross_revenue')} revenue, {total('gross_profit')} gross_profit, {GM} gross_margin_rate
 from fct_sales f join dim_date d using (date_key) join dim_store s using (store_key)
 where d.full_date between date '2023-02-01' and date '2023-03-31' and s.store_name in ('Astoria', 'Lower Manhattan')
 and f.product_key in (select product_key from dim_product where product_category in ('ECONOMY', 'SMALL'))""")(
    lambda t: kpis.sales_totals(
        kpis.slice_gold(
            {n: t.gold[n] for n in ("fct_sales", "fct_waste", "fct_labor", "fct_inventory_snapshot", "dim_date", "dim_store", "dim_product")},
            stores=["Astoria", "Lower Manhattan"], categories=["ECONOMY", "SMALL"],
            date_from="2023-02-01", date_to="2023-03-31",
        )
    )
)

# The four facts behind the slicers, all from one stored cube; the date range has a ragged end on either side.
SLICERS = {"stores": ["Astoria", "Lower Manhattan"], "date_from": "2023-02-10", "date_to": "2023-05-20"}
SLICED = "full_date between date '2023-02-10' and date '2023-05-20' and store_name in ('Astoria', 'Lower Manhattan')"
CATEGORIES = ["ECONOMY", "SMALL", "PROMO"]
INGREDIENT_SLICE = ["milk_ml", "flour_g", "syrup_ml"]
MEMBERS = "join dim_date using (date_key) join dim_store using (store_key)"

query("kpi_14_cube_sales", f"""select year_month, store_name, product_category category, {total('gross_revenue')} revenue,
 {total('gross_profit')} gross_profit, {GM} gross_margin_rate from fct_sales {MEMBERS} join dim_product using (product_key)
 where {SLICED} and product_category in ('ECONOMY', 'SMALL', 'PROMO') group by 1, 2, 3""")(
    lambda t: cube.sales(t.kpi_cube, items=CATEGORIES, by=("year_month", "store_name", "item"), **SLICERS)
    .withColumnRenamed("item", "category")
)
query("kpi_14_cube_sales_all", f"select {total('gross_revenue')} revenue, {total('gross_profit')} gross_profit, "
      f"{GM} gross_margin_rate from fct_sales")(lambda t: cube.sales(t.kpi_cube))
query("kpi_14_cube_labor", f"""select *, case when labor_cost_rate * 100 > 35 then 'OVER TARGET'
 when labor_cost_rate * 100 > 30 then 'WATCH' else 'ON TARGET' end labor_cost_status
 from (select {total('total_labor_cost')} labor_cost, {total('daily_revenue')} labor_revenue, {LABOR_RATE} labor_cost_rate,
 {total('total_hours_worked', 1)} hours_worked, {rate('sum(daily_revenue)', 'sum(total_hours_worked)', 2)} revenue_per_labor_hour
 from fct_labor {MEMBERS} where {SLICED})""")(lambda t: cube.labor(t.kpi_cube, **SLICERS))
query("kpi_14_cube_waste", f"""select year_month, ingredient_name, {WASTE} from fct_waste {MEMBERS} where {SLICED}
 and ingredient_name in ('milk_ml', 'flour_g', 'syrup_ml') group by 1, 2""")(
    lambda t: cube.waste(t.kpi_cube, items=INGREDIENT_SLICE, by=("year_month", "item"), **SLICERS)
    .withColumnRenamed("item", "ingredient_name")
)
SLICED_STOCK = f"(select * from fct_inventory_snapshot {MEMBERS} where {SLICED})"
query("kpi_14_cube_inventory", f"""select store_name, {DAYS} avg_days_inventory, {total('units_received')} units_received,
 (select max(snapshot_date) from {SLICED_STOCK}) snapshot_date,
 {zero('cast(sum(closing_stock) filter (where snapshot_date = (select max(snapshot_date) from ' + SLICED_STOCK
       + ')) as decimal(24,2))', 'decimal(24,2)')} closing_stock,
 count(*) filter (where stockout_risk_flag = 'HIGH' and snapshot_date = (select max(snapshot_date) from {SLICED_STOCK})) stockout_high_count
 from {SLICED_STOCK} group by 1""")(lambda t: cube.inventory(t.kpi_cube, by=("store_name",), **SLICERS))
ORDER_LEVELS = {
    "month": ("year_month", "join dim_date using (date_key)"),
    "store": ("store_name", "join dim_store using (store_key)"),
    "category": ("item", "join dim_product using (product_key)"),
    "total": (None, ""),
}
AOV = f"""count(distinct transaction_id) orders, {total('gross_revenue')} revenue,
 {rate('sum(gross_revenue)', 'count(distinct transaction_id)', 2)} average_order_value"""


@query("kpi_03_orders_rolled_up", " union all ".join(
    f"""select '{level}' split_by, {'product_category' if column == 'item' else column or "'all'"} member, {AOV}
 from fct_sales {relation} {'group by all' if column else ''}""" for level, (column, relation) in ORDER_LEVELS.items()
))
def orders_rolled_up(t):
    """Distinct orders by month, store, category and in total, from one stored table of bitmaps."""
    parts = []
    for level, (column, _) in ORDER_LEVELS.items():
        found = cube.order_values(t.kpi_cube, t.order_cube, by=(column,) if column else ())
        member = F.col(column) if column else F.lit("all")
        parts.append(found.select(
            F.lit(level).alias("split_by"), member.alias("member"), "orders", "revenue", "average_order_value"
        ))
    return reduce(DataFrame.unionByName, parts)


# ---- generators over catalogs derived from the tables --------------------------------------------


def drawn(label, *columns):
    text = " || '|' || ".join(f"cast({c} as varchar)" for c in columns)
    return f"cast('0x' || substr(md5('42|{label}|' || {text}), 1, 8) as bigint)"


def uniform(low, steps, scale, label, *columns):
    step = f"cast('{10**-scale:.{scale}f}' as decimal({scale + 1},{scale}))"
    return f"cast({low} + cast({drawn(label, *columns)} % {steps} as integer) * {step} as decimal(12,{scale}))"


def catalog(t):
    return t.table("part").groupBy(F.col("p_name").alias("product_name")).agg(
        F.min("p_type").alias("product_category"),
        ((10 + F.min("p_partkey") % 40) / 100).cast("decimal(6,4)").alias("cogs_share"),
    )


query("gen_01_product_costs", f"""select product_name, product_category, cast(price as decimal(10,2)) unit_price_std, cost unit_cost,
 cast({ratio('cost', 'price', 4)} as decimal(6,4)) cogs_pct, '2023-01-01' valid_from, '2023-12-31' valid_to, 'ERP_SAP' source_system
 from (select *, cast(price * share * factor as decimal(10,2)) cost from (
 select p_name product_name, min(p_type) product_category, cast(10 + min(p_partkey) % 40 as integer) * cast(0.01 as decimal(3,2)) share,
 {uniform('3.00', 551, 2, 'price', 'p_name')} price, {uniform('0.92', 1601, 4, 'cost', 'p_name')} factor from part group by p_name))""")(
    lambda t: generate.generate_product_costs(catalog(t))
)
INGREDIENTS = (("milk_ml", "ml", 0.002), ("grounds_g", "g", 0.015), ("syrup_ml", "ml", 0.006))
query("gen_02_recipes_bom", """select p_name product_name, i ingredient_name, cast(10 + k % n as decimal(10,4)) qty_required_per_unit,
 u unit_of_measure, cast(c as decimal(10,6)) ingredient_cost_per_unit, '2023-01-01' last_updated
 from (select p_name, min(p_partkey) k from part group by 1)
 cross join (values ('milk_ml', 'ml', 0.002, 7), ('grounds_g', 'g', 0.015, 11)) v(i, u, c, n)""")(
    lambda t: generate.generate_recipes_bom(
        t.table("part").groupBy(F.col("p_name").alias("product_name")).agg(F.min("p_partkey").alias("k")).select(
            "product_name",
            F.create_map(
                F.lit("milk_ml"), (10 + F.col("k") % 7).cast("decimal(10,4)"),
                F.lit("grounds_g"), (10 + F.col("k") % 11).cast("decimal(10,4)"),
            ).alias("amounts"),
        ),
        INGREDIENTS,
    )
)


def supplier_stores(t):
    """Every supplier taken as a store, so that the generated volume follows the tables."""
    return t.table("supplier").select(F.col("s_suppkey").cast("int").alias("store_id"), F.col("s_name").alias("store_name"))


DAYS_GRID = "generate_series(date '2023-01-01', date '2023-06-30', interval 1 day) g(ts)"
query("gen_03_daily_inventory", f"""
with recursive stores as materialized (select cast(s_suppkey as integer) store_id, s_name store_name from supplier),
series as materialized (select store_id, store_name, ingredient_name from stores cross join (values ('milk_ml'), ('grounds_g'), ('syrup_ml')) i(ingredient_name)),
moves as materialized (select s.*, cast(ts as date) inventory_date,
 cast({uniform('40', 800001, 4, 'base', 'store_id', 'ingredient_name', 'cast(ts as date)')}
 * case when isodow(ts) >= 6 then cast(1.35 as decimal(3,2)) else cast(1.00 as decimal(3,2)) end
 * {uniform('1.05', 1001, 4, 'waste', 'store_id', 'ingredient_name', 'cast(ts as date)')} as decimal(12,1)) consumed,
 case when isodow(ts) = 1 then {uniform('600', 3001, 1, 'receipt', 'store_id', 'ingredient_name', 'cast(ts as date)')} else 0 end restock
 from series s cross join {DAYS_GRID}),
fold as (
 select store_id, store_name, ingredient_name, date '2022-12-31' inventory_date, cast(0 as decimal(12,1)) opening, cast(0 as decimal(12,1)) received,
 cast(0 as decimal(12,1)) consumed, {uniform('600', 8001, 1, 'stock', 'store_id', 'ingredient_name')} closing from series
 union all
 select m.store_id, m.store_name, m.ingredient_name, m.inventory_date, f.closing,
 cast(case when f.closing < 350 then m.restock else 0 end as decimal(12,1)), m.consumed,
 cast(greatest(0, f.closing + case when f.closing < 350 then m.restock else 0 end - m.consumed) as decimal(12,1))
 from fold f join moves m on m.store_id = f.store_id and m.ingredient_name = f.ingredient_name and m.inventory_date = f.inventory_date + 1)
select inventory_date, store_id, store_name, ingredient_name, opening opening_stock, received units_received, consumed actual_consumed,
 closing closing_stock from fold where inventory_date > date '2022-12-31'""", complete=True)(
    lambda t: generate.generate_daily_inventory(supplier_stores(t), INGREDIENTS)
)
query("gen_04_staff_shifts", f"""
select shift_date, store_id, store_name, shift_type, shift_start, shift_end, emp employees_on_shift,
 cast(h as decimal(4,1)) hours_per_employee, cast(emp * h as decimal(6,1)) total_hours, cast(r as decimal(6,2)) hourly_rate_usd,
 cast(emp * h * r * {uniform('0.98', 701, 4, 'labor', 'store_id', 'shift_date', 'shift_type')} as decimal(10,2)) labor_cost_usd
from (select cast(ts as date) shift_date, cast(s_suppkey as integer) store_id, s_name store_name, v.*,
 cast(e + case when x and isodow(ts) >= 6 then 1 else 0 end as integer) emp
 from supplier cross join {DAYS_GRID} cross join (values ('morning', '06:00', '10:00', 3, 4, 15.0, true),
 ('midday', '10:00', '14:00', 4, 4, 15.0, true), ('afternoon', '14:00', '18:00', 2, 4, 15.5, false),
 ('closing', '18:00', '21:00', 2, 3, 15.5, false)) v(shift_type, shift_start, shift_end, e, h, r, x))""")(
    lambda t: generate.generate_staff_shifts(supplier_stores(t))
)
