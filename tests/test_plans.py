"""Models, gates, diagnostics and KPIs on small hand-made tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, as_list, as_set
from tallyhouse.operators import constraints
from tallyhouse.plans import daily, diagnostics, dimensions, facts, generate, intermediate, kpis, quality
from workload import catalog
from workload.bound import Bound

D = Decimal
DAY = dt.date


def test_margin_is_null_without_cost_or_revenue(rows):
    lines = rows(
        [("a", DAY(2023, 1, 1), 2, D(10)), ("b", DAY(2023, 1, 1), 1, D(5)), ("a", DAY(2023, 1, 1), 1, D(0))],
        "product_name string, transaction_date date, transaction_qty int, gross_revenue decimal(20,2)",
    )
    costs = rows(
        [("a", D("2.5"), D("0.5"), DAY(2023, 1, 1), DAY(2023, 12, 31))],
        "product_name string, unit_cost decimal(10,4), cogs_pct decimal(6,4), valid_from date, valid_to date",
    )
    out = intermediate.sales_with_costs(lines, costs)
    assert as_set(out, "gross_revenue", "cogs_amount", "gross_profit", "gross_margin_pct") == {
        (D(10), D(5), D(5), D(50)), (D(5), None, None, None), (D(0), D("2.5"), D("-2.5"), None),
    }


@pytest.mark.parametrize(
    ("pct", "status"),
    [("30", "ON TARGET"), ("30.01", "WATCH"), ("35", "WATCH"), ("35.01", "OVER TARGET"), (None, "ON TARGET")],
)
def test_labor_status_limits(rows, pct, status):
    df = rows([(D(pct) if pct else None,)], "labor_cost_pct decimal(18,2)")
    assert df.select(facts.labor_status()).first()[0] == status


@pytest.mark.parametrize(
    ("days", "risk"), [("1.99", "HIGH"), ("2", "MEDIUM"), ("3.99", "MEDIUM"), ("4", "LOW"), (None, "LOW")]
)
def test_stock_risk_limits(rows, days, risk):
    df = rows([(D(days) if days else None,)], "d decimal(18,4)")
    assert df.select(facts.stock_risk(F.col("d"))).first()[0] == risk


@pytest.mark.parametrize(
    ("cogs", "tier"), [("0.30", "High Margin"), ("0.45", "Medium Margin"), ("0.46", "Low Margin"), (None, "Unknown")]
)
def test_margin_tier_limits(rows, cogs, tier):
    df = rows([(D(cogs) if cogs else None,)], "cogs_pct decimal(6,4)")
    assert df.select(dimensions.margin_tier()).first()[0] == tier


def test_risk_uses_the_quotient_before_rounding(rows):
    # 1.96 days show as 2.0 but are still high risk.
    df = rows([(3, "milk", DAY(2023, 1, 1), D("196"), D("100"))],
              "store_id int, ingredient_name string, inventory_date date, closing_stock decimal(12,2), actual_consumed decimal(12,2)")
    out = facts.inventory_coverage(df).first()
    assert (out.days_of_inventory_remaining, out.stockout_risk_flag) == (D("2.0"), "HIGH")


def test_store_lookup_falls_back_to_location(rows):
    lines = rows([(3, "Loc 3"), (99, "Loc 99"), (None, "Loc")], "store_id int, store_location string")
    got = as_set(dimensions.build_dim_store(lines), "store_id", "store_name", "borough")
    assert got == {(3, "Astoria", "Queens"), (99, "Loc 99", None), (None, "Loc", None)}


COSTED = "product_name string, product_category string, unit_price_std decimal(10,2), unit_cost decimal(10,4), " \
         "cogs_pct decimal(6,4), valid_from date, valid_to date, source_system string"


def test_product_dimension_fans_out_unless_as_of(rows):
    lines = rows([("a", "c", "t", "g")], "product_name string, product_category string, product_type string, product_group string")
    costs = rows(
        [("a", "C", D(3), D(1), D("0.3"), DAY(2023, 1, 1), DAY(2023, 6, 30), "E"),
         ("a", "C", D(3), D(2), D("0.6"), DAY(2023, 7, 1), DAY(2023, 12, 31), "E")], COSTED,
    )
    fanned = dimensions.build_dim_product(lines, costs)
    assert fanned.count() == 2
    assert as_list(constraints.unique(fanned, "product_key"), "n_records") == [(2,)]
    picked = dimensions.build_dim_product(lines, costs, as_of="2023-08-01")
    assert as_list(picked, "product_category", "margin_tier") == [("C", "Low Margin")]


def test_waste_keeps_theoretical_days_only(rows):
    theoretical = rows(
        [(DAY(2023, 1, 1), 3, "milk", "ml", D("0.002"), D(100)), (DAY(2023, 1, 2), 3, "milk", "ml", D("0.002"), D(0))],
        "transaction_date date, store_id int, ingredient_name string, unit_of_measure string, "
        "ingredient_cost_per_unit decimal(10,6), theoretical_consumption decimal(24,4)",
    )
    counts = rows([(DAY(2023, 1, 1), 3, "milk", D(110)), (DAY(2023, 1, 3), 3, "milk", D(5))],
                  "inventory_date date, store_id int, ingredient_name string, actual_consumed decimal(12,2)")
    got = as_set(facts.waste_measures(theoretical, counts), "transaction_date", "waste_qty", "waste_amount_usd", "waste_rate_pct")
    assert got == {(DAY(2023, 1, 1), D(10), D("0.02"), D(10)), (DAY(2023, 1, 2), None, None, None)}


POS = "transaction_qty string, unit_price string, store_id string, store_location string, transaction_date string, " \
      "product_detail string, ingestion_date string"


def pos_rows(rows, n, stores=(3, 5, 8), qty="1", price="2", date="2023-06-15"):
    data = [(qty, price, str(stores[i % len(stores)]), "L", "2023-06-01", "Latte", date) for i in range(n)]
    return rows(data, POS)


@pytest.mark.parametrize(("n", "stores", "failures"), [(300, (3, 5, 8), 0), (299, (3, 5, 8), 1), (300, (3, 5), 1), (0, (3,), 0)])
def test_row_count_gate(rows, n, stores, failures):
    tables = {"bronze_pos_transactions": pos_rows(rows, n, stores)}
    assert quality.gate_row_count(tables).count() == failures


def test_sources_gate_reports_empty_sources(rows):
    empty = rows([], "ingestion_date string")
    tables = {
        "bronze_pos_transactions": pos_rows(rows, 1), "bronze_daily_inventory": empty, "bronze_staff_shifts": pos_rows(rows, 1),
    }
    assert as_list(quality.gate_sources_arrived(tables), "source_name", "row_count") == [("bronze_daily_inventory", 0)]


def test_value_gate(rows):
    good, bad = pos_rows(rows, 3), pos_rows(rows, 2, qty="-4", price="0")
    tables = {"bronze_pos_transactions": good.unionByName(bad)}
    assert as_set(quality.gate_negative_values(tables), "field_name", "invalid_count", "min_value") == {
        ("unit_price", 2, 0.0), ("transaction_qty", 2, -4.0),
    }
    assert quality.gate_negative_values({"bronze_pos_transactions": good}).count() == 0


def test_gates_agree_on_lines_and_on_their_profile(rows):
    pos = pos_rows(rows, 5, (3, 9)).unionByName(pos_rows(rows, 3, qty="-1", price="0")).unionByName(pos_rows(rows, 2, date="2023-06-01"))
    mapping = rows([], "pos_product_detail string, canonical_product_name string, cost_required string")
    tables = {"bronze_pos_transactions": pos, "product_name_mapping": mapping, "bronze_product_costs": rows([], "product_name string"),
              "stg_pos_transactions": pos_rows(rows, 2)}
    profiled = tables | {"pos_profile": quality.pos_profile(pos)}
    assert quality.pos_profile(pos).agg(F.sum("n_lines")).first()[0] == 8
    for gate in (quality.gate_row_count, quality.gate_negative_values, quality.gate_known_stores, quality.gate_cost_coverage,
                 quality.gate_silver_parity):
        found = as_set(gate(tables))
        assert found and found == as_set(gate(profiled))


def test_store_gate_ignores_null(rows):
    df = pos_rows(rows, 2, (3, 9)).unionByName(pos_rows(rows, 1).withColumn("store_id", F.lit(None).cast("string")))
    assert as_list(quality.gate_known_stores({"bronze_pos_transactions": df}), "store_id") == [("9",)]


def inventory(rows, gap):
    return rows(
        [("2023-01-01", "3", "milk", "0", "100"), ("2023-01-03", "3", "milk", str(100 + gap), "1"), ("2023-01-03", "5", "milk", "7", "1")],
        "inventory_date string, store_id string, ingredient_name string, opening_stock string, closing_stock string",
    )


def test_continuity_gate(rows):
    at_limit = as_set(quality.gate_inventory_continuity({"bronze_daily_inventory": inventory(rows, 5)}), "store_id", "status")
    assert at_limit == {(5, "WARNING: no inventory record for yesterday")}
    beyond = as_set(quality.gate_inventory_continuity({"bronze_daily_inventory": inventory(rows, 5.01)}), "store_id", "status")
    assert (3, "WARNING: inventory gap > 5 units between days") in beyond


@pytest.mark.parametrize(("cost", "qty", "status"), [
    ("60", "1", None), ("60.01", "1", "INFO: labor % above 60 - verify data"), ("1", "0", None),
])
def test_labor_gate(rows, cost, qty, status):
    pos = rows([(qty, "100", "3", "L", "2023-06-01", "x", "2023-06-15")], POS)
    shifts = rows([("2023-06-01", "3", cost, "2023-06-15")],
                  "shift_date string, store_id string, labor_cost_usd string, ingestion_date string")
    out = quality.gate_labor_ratio({"bronze_pos_transactions": pos, "bronze_staff_shifts": shifts})
    assert as_list(out, "status") == ([(status,)] if status else [])


def test_labor_gate_without_revenue(rows):
    pos = rows([("1", "100", "5", "L", "2023-06-01", "x", "2023-06-15")], POS)
    shifts = rows([("2023-06-01", "3", "10", "2023-06-15")],
                  "shift_date string, store_id string, labor_cost_usd string, ingestion_date string")
    out = quality.gate_labor_ratio({"bronze_pos_transactions": pos, "bronze_staff_shifts": shifts})
    assert as_list(out, "status") == [("WARNING: no revenue data for this store",)]


@pytest.mark.parametrize(("kept", "failures"), [(99, 0), (98, 1)])
def test_parity_gate(rows, kept, failures):
    tables = {"bronze_pos_transactions": pos_rows(rows, 100), "stg_pos_transactions": pos_rows(rows, kept)}
    assert quality.gate_silver_parity(tables).count() == failures


def test_parity_gate_passes_without_bronze_rows(rows):
    tables = {"bronze_pos_transactions": pos_rows(rows, 0), "stg_pos_transactions": pos_rows(rows, 0)}
    assert quality.gate_silver_parity(tables).count() == 0



GATE_BLOCK = {"w": quality.Gate("WARNING", lambda t: t["bad"]), "c": quality.Gate("CRITICAL", lambda t: t["good"])}


def test_runner_reports_warnings_and_goes_on(spark, rows, monkeypatch):
    monkeypatch.setattr(quality, "BLOCKS", {"all": ("w", "c")})
    monkeypatch.setattr(quality.expand_blocks, "__defaults__", (None, {"all": ("w", "c")}))
    tables = {"bad": rows([(i,) for i in range(5)], "x int"), "good": rows([], "x int")}
    stored = []
    results, summary = quality.run_gates(
        spark, tables, ["nope", "all"], run_date="2023-06-15", gates=GATE_BLOCK, store=lambda r, f: stored.append((r, f))
    )
    assert summary["warnings"] == ["w"] and summary["passed"] == ["c"]
    assert summary["notes"] == ["unknown block skipped: nope"]
    assert as_set(results, "gate", "status", "n_failures") == {("w", "FAIL", 5), ("c", "PASS", 0)}
    assert [len(r.sample) for r in results.orderBy("gate").collect()] == [0, 3]
    assert stored[0][1]["w"].count() == 5


def test_runner_raises_after_storing(spark, rows):
    gates = {n: quality.Gate(g.level, None if n == "02_all_sources" else (lambda t: t["bad"])) for n, g in quality.GATES.items()}
    stored = []
    with pytest.raises(quality.CriticalGateFailure) as stop:
        quality.run_gates(spark, {"bad": rows([(1,)], "x int")}, ["completeness"], run_date="d", gates=gates,
                          store=lambda r, f: stored.append(r))
    assert stop.value.failed == ["01_row_count", "02_all_sources"]
    assert as_set(stored[0], "gate", "status") == {("01_row_count", "FAIL"), ("02_all_sources", "ERROR")}


def test_runner_notes_a_failing_store(spark, rows):
    def broken(results, failures):
        raise OSError("disk")

    gates = {n: quality.Gate(g.level, lambda t: t["good"]) for n, g in quality.GATES.items()}
    _, summary = quality.run_gates(spark, {"good": rows([], "x int")}, ["parity"], run_date="d", gates=gates, store=broken)
    assert summary["notes"] == ["results not stored: disk"]


def test_blocks_expand_once_and_need_a_known_name():
    names, unknown = quality.expand_blocks(["integrity", "all", "x"])
    assert names[:3] == ["03_negative_values", "04_referential", "05_cost_coverage"]
    assert len(names) == 8 and unknown == ["x"]
    with pytest.raises(ValueError, match="No known"):
        quality.expand_blocks(["x"])


def test_backlog_actions(rows):
    pos = rows([("Latte Lg", "Coffee", "d"), ("Mug", "Branded", "d"), ("Tea", "Tea", "d"), ("Pie", "Bakery", "d"), ("Old", "Tea", "d")],
               "product_detail string, product_category string, ingestion_date string")
    mapping = rows([(" Old ",)], "pos_product_detail string")
    costs, bom = rows([("Latte",), ("Pie",)], "product_name string"), rows([("Latte",), ("Latte",), ("Tea",)], "product_name string")
    out = diagnostics.mapping_backlog(pos, mapping, costs, bom)
    assert as_set(out, "pos_product_detail", "suggested_size_code", "suggested_cost_required", "suggested_action") == {
        ("Latte Lg", "Lg", "true", "Add mapping only"), ("Mug", None, "false", "Add mapping + cost + recipe"),
        ("Tea", None, "true", "Add mapping + cost"), ("Pie", None, "true", "Add mapping + recipe"),
    }
    assert as_list(diagnostics.backlog_summary(out))[0][1] == 1


def test_generators_are_repeatable_and_follow_their_rules(spark):
    stores = generate.store_table(spark)
    first = generate.generate_daily_inventory(stores)
    again = generate.generate_daily_inventory(stores.repartition(7))
    assert first.count() == 3 * 181 * 10
    assert first.exceptAll(again).count() == 0
    assert generate.generate_daily_inventory(stores, seed=1).exceptAll(first).count() > 0
    series = first.where("store_id = 3 and ingredient_name = 'flour_g'").orderBy("inventory_date").collect()
    for before, after in zip(series, series[1:]):
        assert after.opening_stock == before.closing_stock
        restock = after.inventory_date.weekday() == 0 and after.opening_stock < 350
        assert (after.units_received > 0) == restock
        assert after.closing_stock == max(D(0), after.opening_stock + after.units_received - after.actual_consumed)
    assert 600 <= series[0].opening_stock <= 1400
    shifts = generate.generate_staff_shifts(stores)
    assert shifts.count() == 3 * 181 * 4
    weekend = shifts.where("shift_date = '2023-01-01' and store_id = 3")
    assert as_set(weekend, "shift_type", "employees_on_shift") == {("morning", 4), ("midday", 5), ("afternoon", 2), ("closing", 2)}
    costs = generate.generate_product_costs(generate.product_catalog(spark))
    assert costs.count() == 53
    assert costs.where("unit_price_std < 3 or unit_price_std > 8.5 or unit_cost > unit_price_std").count() == 0
    bom = generate.generate_recipes_bom(generate.recipe_table(spark))
    assert (bom.count(), bom.select("product_name").distinct().count()) == (83, 47)
    assert generate.generate_promotions(spark).count() == 3


def test_kpis_of_empty_facts_are_zero(rows):
    sales = rows([], "transaction_id string, gross_revenue decimal(20,2), gross_profit decimal(20,2)")
    labor = rows([], "total_labor_cost decimal(20,2), daily_revenue decimal(20,2), total_hours_worked decimal(16,1)")
    gold = {"fct_sales": sales, "fct_labor": labor}
    assert as_list(kpis.sales_totals(gold)) == [(D(0), D(0), D(0))]
    assert as_list(kpis.order_value(gold)) == [(0, D(0), D(0))]
    assert kpis.labor_share(gold).first().labor_cost_status == "ON TARGET"
    assert kpis.revenue_per_labor_hour(gold).first().revenue_per_labor_hour == 0


def test_calendar_spans_all_business_dates(rows):
    silver = {
        "stg_pos_transactions": rows([(dt.date(2023, 12, 30),), (dt.date(2024, 1, 2),)], "transaction_date date"),
        "stg_daily_inventory": rows([(dt.date(2024, 1, 4),)], "inventory_date date"),
        "stg_staff_shifts": rows([], "shift_date date"),
    }
    days = [r.full_date for r in daily.business_calendar(silver).orderBy("full_date").collect()]
    assert days[0] == dt.date(2023, 12, 30) and days[-1] == dt.date(2024, 1, 4) and len(days) == 6


def test_gold_tests_read_each_fact_from_a_stored_table(spark):
    report = catalog.QUERIES["ct_all_gold_tests"][0](Bound(spark, SF_DIR))
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    # The facts are not worked out again by each test.
    assert "lineitem" not in plan and "l_orderkey" not in plan and "RowNumber" not in plan and "row_number" not in plan


def test_lines_are_worked_out_once_for_all_gold_tables(spark):
    bound = Bound(spark, SF_DIR)
    waste = bound.full_gold["fct_waste"]._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in waste


def test_few_stores_in_one_file_are_generated_by_many_tasks(spark):
    stores = spark.range(60).selectExpr("cast(id as int) store_id", "'s' store_name").coalesce(1)
    for made in (
        generate.generate_daily_inventory(stores, last_day="2023-01-02"), generate.generate_staff_shifts(stores, last_day="2023-01-02")
    ):
        assert made.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
