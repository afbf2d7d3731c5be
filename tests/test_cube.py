"""The KPI cube against slices of the facts themselves."""

import datetime as dt
import itertools
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import as_list
from tallyhouse.functions.calendar import calendar_columns, date_spine
from tallyhouse.plans import cube, kpis
from tallyhouse.sources import gold

FIRST, DAYS = dt.date(2023, 1, 20), 100
STORES, CATEGORIES, INGREDIENTS = ["A", "B", "C"], ["hot", "cold"], ["milk", "flour", "syrup"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(2)
    spine = date_spine(spark, str(FIRST), str(FIRST + dt.timedelta(days=DAYS)))
    days = [FIRST + dt.timedelta(days=i) for i in range(DAYS)]
    key = lambda d: int(d.strftime("%Y%m%d"))
    sales, labor, waste, stock = [], [], [], []
    for d in days:
        for s in range(3):
            for _ in range(rng.randrange(4)):
                order = rng.choice([None, f"t{rng.randrange(200)}"])
                sales.append((order, key(d), f"s{s}", rng.choice(["p0", "p1", "p2", "unlisted"]), D(rng.randrange(1000)) / 100, rng.choice([None, D(3)])))
            labor.append((key(d), f"s{s}", D(rng.randrange(500)), rng.choice([None, D(rng.randrange(900))]), D("4.0")))
            for i in INGREDIENTS:
                waste.append((key(d), f"s{s}", i, D(rng.randrange(-50, 50)), D(rng.randrange(-50, 50)), D(rng.randrange(90))))
                stock.append((key(d), f"s{s}", i, d, rng.choice([None, D("2.5"), D("7.1")]), D(rng.randrange(90)), D(2), rng.choice(["HIGH", "LOW"])))
    sales += [("t1", None, "s0", "p0", D(7), D(1)), ("t2", key(FIRST), "gone", "p0", D(9), D(1))]
    money = "decimal(20,2)"
    frames = {
        "dim_date": spine.select(*calendar_columns()),
        "dim_store": spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(STORES)], "store_key string, store_name string"),
        "dim_product": spark.createDataFrame([("p0", "hot"), ("p1", "cold"), ("p2", "hot")], "product_key string, product_category string"),
        "fct_sales": spark.createDataFrame(sales, f"transaction_id string, date_key int, store_key string, product_key string, gross_revenue {money}, gross_profit {money}"),
        "fct_labor": spark.createDataFrame(labor, f"date_key int, store_key string, total_labor_cost {money}, daily_revenue {money}, total_hours_worked decimal(16,1)"),
        "fct_waste": spark.createDataFrame(waste, "date_key int, store_key string, ingredient_name string, waste_amount_usd decimal(24,4), waste_qty decimal(24,4), theoretical_consumption decimal(24,4)"),
        "fct_inventory_snapshot": spark.createDataFrame(stock, "date_key int, store_key string, ingredient_name string, snapshot_date date, days_of_inventory_remaining decimal(18,1), closing_stock decimal(12,2), units_received decimal(12,2), stockout_risk_flag string"),
    }
    root = str(tmp_path_factory.mktemp("cube"))
    for name, df in frames.items():
        gold.write_table(df, root, name)
    return {name: gold.read_table(spark, root, name) for name in frames}


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    gold.write_table(cube.build_cube(tables), root, "kpi_cube", partition_by=["fact", "level"])
    gold.write_table(cube.build_order_cube(tables), root, "order_cube", partition_by=["fact", "level"])
    return gold.read_table(spark, root, "kpi_cube"), gold.read_table(spark, root, "order_cube")


SLICES = [
    {},
    {"stores": ["A", "C"]},
    {"date_from": "2023-02-01", "date_to": "2023-03-31"},
    {"date_from": "2023-01-25", "date_to": "2023-04-03", "stores": ["B"]},
    {"date_from": "2023-02-10", "date_to": "2023-02-20"},
    {"date_from": "2023-02-15"},
    {"date_to": "2023-03-14", "stores": ["A", "B", "C"]},
    {"date_from": "2030-01-01"},
]


@pytest.mark.parametrize("slicers", SLICES, ids=str)
def test_slices_equal_the_facts(tables, stored, slicers):
    kpi = stored[0]
    sliced = kpis.slice_gold(tables, **slicers)
    assert as_list(cube.sales(kpi, **slicers)) == as_list(kpis.sales_totals(sliced))
    assert as_list(cube.labor(kpi, **slicers), "labor_cost", "labor_revenue", "labor_cost_rate", "labor_cost_status") == as_list(kpis.labor_share(sliced))
    assert as_list(cube.labor(kpi, **slicers), "labor_revenue", "hours_worked", "revenue_per_labor_hour") == as_list(kpis.revenue_per_labor_hour(sliced))
    assert as_list(cube.waste(kpi, **slicers)) == as_list(kpis.waste_totals(sliced))
    got = as_list(cube.inventory(kpi, **slicers), "avg_days_inventory", "units_received", "closing_stock")
    assert got == as_list(kpis.inventory_totals(sliced))
    assert as_list(cube.inventory(kpi, **slicers), "snapshot_date", "stockout_high_count") == as_list(kpis.stockouts(sliced))


@pytest.mark.parametrize("by", [("year_month",), ("store_name",), ("item",), ("day", "store_name"), ("year_month", "item")])
def test_groups_equal_the_facts(tables, stored, by):
    slicers = {"date_from": "2023-01-25", "date_to": "2023-04-03"}
    sliced = kpis.slice_gold(tables, **slicers)
    columns = [{"day": "full_date", "item": "product_category"}.get(c, c) for c in by]
    want = {tuple(r) for r in kpis.revenue_by(sliced, *columns).collect()}
    got = {tuple(r) for r in cube.sales(stored[0], by=by, **slicers).select(*by, "revenue").collect()}
    assert got == want


def test_categories_filter_sales_and_ingredients_waste(tables, stored):
    sliced = kpis.slice_gold(tables, categories=["hot"], stores=["A"])
    assert as_list(cube.sales(stored[0], items=["hot"], stores=["A"])) == as_list(kpis.sales_totals(sliced))
    milk = {**tables, "fct_waste": tables["fct_waste"].where("ingredient_name = 'milk'")}
    assert as_list(cube.waste(stored[0], items=["milk"])) == as_list(kpis.waste_totals(milk))


@pytest.mark.parametrize("slicers", SLICES[:5], ids=str)
def test_distinct_orders_add_up_over_any_cells(tables, stored, slicers):
    sliced = kpis.slice_gold(tables, **slicers)
    assert as_list(cube.order_values(*stored, **slicers), "orders", "revenue", "average_order_value") == as_list(kpis.order_value(sliced))
    names = tables["fct_sales"].join(tables["dim_store"], "store_key").join(tables["dim_product"], "product_key")
    if not slicers:
        want = {tuple(r) for r in names.groupBy("store_name", "product_category").agg(F.countDistinct("transaction_id")).collect()}
        got = {tuple(r) for r in cube.distinct_orders(stored[1], by=("store_name", "item")).collect()}
        assert got == want


def test_whole_months():
    day = dt.date
    assert cube.whole_months(day(2023, 1, 1), day(2023, 3, 31)) == (day(2023, 1, 1), day(2023, 3, 31))
    assert cube.whole_months(day(2023, 1, 2), day(2023, 3, 30)) == (day(2023, 2, 1), day(2023, 2, 28))
    assert cube.whole_months(day(2023, 12, 31), day(2024, 1, 30)) is None
    for a, n in itertools.product(range(0, 60, 7), range(0, 80, 9)):
        first = day(2023, 11, 5) + dt.timedelta(days=a)
        last = first + dt.timedelta(days=n)
        whole = cube.whole_months(first, last)
        months = {(first + dt.timedelta(days=i)).strftime("%Y-%m") for i in range(n + 1)}
        full = [m for m in sorted(months) if all(
            first <= d <= last for d in (day(int(m[:4]), int(m[5:]), 1) + dt.timedelta(days=i) for i in range(31)) if d.strftime("%Y-%m") == m
        )]
        assert (whole and (whole[0].strftime("%Y-%m"), whole[1].strftime("%Y-%m"))) == ((full[0], full[-1]) if full else None)


def test_each_fact_is_scanned_once_and_slices_open_their_folders(tables, stored):
    plan = cube.build_cube(tables)._jdf.queryExecution().optimizedPlan().toString()
    for column in ("gross_revenue", "total_labor_cost", "waste_amount_usd", "closing_stock"):
        assert sum(line.strip(" :+-").startswith("Relation") and column in line for line in plan.split("\n")) == 1, column
    sliced = cube.sales(stored[0], date_from="2023-02-01", date_to="2023-03-31")
    scan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fact" in scan and "month_all_all" in scan


def test_empty_facts(tables):
    empty = {name: df.limit(0) if name.startswith("fct") else df for name, df in tables.items()}
    built = cube.build_cube(empty)
    assert as_list(cube.sales(built)) == as_list(kpis.sales_totals(empty))
    assert as_list(cube.order_values(built, cube.build_order_cube(empty)), "orders") == [(0,)]
