"""Fingerprints, and the rebuild of changed days against full builds."""

import datetime as dt
import random
from decimal import Decimal as D
from pathlib import Path

import pytest

from conftest import as_list, as_set
from tallyhouse.functions import fingerprints
from tallyhouse.operators import staging
from tallyhouse.plans import dimensions, rebuild

DAY = dt.date
SCHEMAS = {
    "stg_pos_transactions": "transaction_id string, transaction_line_number bigint, store_id int, product_id int, transaction_date date, "
    "transaction_time string, transaction_hour int, transaction_qty int, unit_price decimal(10,2), gross_revenue decimal(20,2), "
    "store_location string, product_category string, product_type string, product_name_raw string, product_name string, size_code string, "
    "cost_required boolean, recipe_required boolean, product_group string, ingestion_date string",
    "stg_product_costs": "product_name string, product_category string, unit_price_std decimal(10,2), unit_cost decimal(10,4), "
    "cogs_pct decimal(6,4), valid_from date, valid_to date, source_system string, ingestion_date string",
    "stg_recipes_bom": "product_name string, ingredient_name string, qty_required_per_unit decimal(10,4), unit_of_measure string, "
    "ingredient_cost_per_unit decimal(10,6), last_updated date, ingestion_date string",
    "stg_daily_inventory": "inventory_date date, store_id int, store_name string, ingredient_name string, opening_stock decimal(12,2), "
    "units_received decimal(12,2), actual_consumed decimal(12,2), closing_stock decimal(12,2), ingestion_date string",
    "stg_staff_shifts": "shift_date date, store_id int, labor_cost_usd decimal(10,2), total_hours decimal(6,1), employees_on_shift int, ingestion_date string",
}


def day(n):
    return DAY(2023, 1, 1) + dt.timedelta(days=n)


def inputs():
    rng = random.Random(3)
    lines, counts, shifts = [], [], []
    for n in range(30):
        for store in (3, 5):
            for k in range(2):
                product = rng.choice(["Latte", "Mug", "Tea"])
                qty = rng.randrange(1, 4)
                lines.append([f"t{n}-{store}-{k}", 1, store, 1, day(n), "07:00:00", 7, qty, D(4), D(4 * qty), f"L{store}", "c", "t", product, product, None, True, True, "g", "x"])
            if not (store == 5 and n % 3):
                counts.append([day(n), store, f"L{store}", "milk", D(90), D(5), D(rng.randrange(5, 9)), D(50), "x"])
            shifts.append([day(n), store, D(20), D("4.0"), 2, "x"])
    costs = [["Latte", "c", D(4), D(1), D("0.25"), day(0), day(400), "ERP", "x"], ["Tea", "c", D(4), D(2), D("0.5"), day(0), day(400), "ERP", "x"]]
    recipes = [["Latte", "milk", D(2), "ml", D("0.01"), day(0), "x"], ["Tea", "milk", D(1), "ml", D("0.01"), day(0), "x"]]
    return dict(zip(SCHEMAS, (lines, costs, recipes, counts, shifts)))


def frames(spark, data):
    silver = {name: spark.createDataFrame([tuple(r) for r in data[name]], schema) for name, schema in SCHEMAS.items()}
    lines = silver["stg_pos_transactions"]
    dims = {
        "dim_date": dimensions.build_dim_date(spark, "2023-01-01", "2023-03-01"),
        "dim_store": dimensions.build_dim_store(lines),
        "dim_product": dimensions.build_dim_product(lines, silver["stg_product_costs"]),
        "dim_ingredient": dimensions.build_dim_ingredient(silver["stg_recipes_bom"]),
    }
    return silver, dims


def contents(spark, root, fact):
    df = rebuild.read_fact(spark, root, fact)
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def files(root, fact):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root, "gold", fact).rglob("part-*")}


def change(data):
    """Three days of lines, a count and its successors, a shift, a cost and a recipe differ."""
    lines, counts = data["stg_pos_transactions"], data["stg_daily_inventory"]
    for row in lines:
        if row[4] == day(4):
            row[7], row[9] = row[7] + 1, row[9] + 4
        if row[4] == day(9):
            row[4] = day(40)
    data["stg_pos_transactions"] = [r for r in lines if r[4] != day(12)]
    data["stg_daily_inventory"] = [r for r in counts if not (r[0] == day(6) and r[1] == 3)]
    for row in data["stg_staff_shifts"]:
        if row[0] == day(20):
            row[2] = D(33)
    return data


def test_rebuild_equals_full_build_and_leaves_other_folders(spark, tmp_path):
    kept, whole = str(tmp_path / "kept"), str(tmp_path / "whole")
    silver, dims = frames(spark, inputs())
    first = rebuild.rebuild(spark, silver, dims, kept)
    # Days of the calendar without rows count as changed too, and store nothing.
    assert first["fct_labor"] == [day(n) for n in range(59)]
    before = {fact: files(kept, fact) for fact in rebuild.FACT_DAYS}
    assert rebuild.rebuild(spark, silver, dims, kept) == {fact: [] for fact in rebuild.FACT_DAYS}

    silver, dims = frames(spark, change(inputs()))
    days = rebuild.rebuild(spark, silver, dims, kept)
    rebuild.rebuild(spark, silver, dims, whole)
    lines = [day(4), day(9), day(12), day(40)]
    assert days["fct_sales"] == lines
    assert days["fct_waste"] == sorted([*lines, day(6)])
    assert days["fct_labor"] == sorted([*lines, day(20)])
    # The seven records from the missing one on, in a series of daily counts; the other store's records are not concerned
    # beyond those whose means reach back to the day.
    assert {day(n) for n in range(6, 14)} - {day(13)} <= set(days["fct_inventory_snapshot"])
    assert max(days["fct_inventory_snapshot"]) <= day(24) and day(5) not in days["fct_inventory_snapshot"]
    for fact in rebuild.FACT_DAYS:
        assert contents(spark, kept, fact) == contents(spark, whole, fact), fact
        after = files(kept, fact)
        folders = {f"{rebuild.FOLDER}={d.isoformat()}" for d in days[fact]}
        untouched = {f: t for f, t in before[fact].items() if Path(f).parts[-2] not in folders}
        assert untouched and untouched.items() <= after.items()
    assert not (Path(kept) / "gold" / "fct_sales" / f"{rebuild.FOLDER}={day(12).isoformat()}").exists()


@pytest.mark.parametrize("what", ["cost", "recipe", "second cost"])
def test_undated_inputs_concern_the_days_that_use_them(spark, tmp_path, what):
    data = inputs()
    root, whole = str(tmp_path / "a"), str(tmp_path / "b")
    rebuild.rebuild(spark, *frames(spark, data), root, only=("fct_sales", "fct_waste"))
    sold = sorted({r[4] for r in data["stg_pos_transactions"] if r[14] == "Tea"})
    if what == "cost":
        data["stg_product_costs"][1][3] = D(3)
    elif what == "second cost":
        data["stg_product_costs"].append(["Tea", "c", D(4), D(1), D("0.25"), day(500), day(600), "ERP", "x"])
    else:
        data["stg_recipes_bom"][1][2] = D(5)
    days = rebuild.rebuild(spark, *frames(spark, data), root, only=("fct_sales", "fct_waste"))
    assert days == {"fct_sales": [] if what == "recipe" else sold, "fct_waste": sold if what == "recipe" else []}
    rebuild.rebuild(spark, *frames(spark, data), whole, only=("fct_sales", "fct_waste"))
    for fact in ("fct_sales", "fct_waste"):
        assert contents(spark, root, fact) == contents(spark, whole, fact)


def test_fingerprints_tell_multisets_apart(spark, rows):
    schema = "a string, b int"
    base = [("x", 1), ("x", 1), ("y", None), (None, 2)]

    def of(data):
        return as_list(fingerprints.table_fingerprint(rows(data, schema).repartition(3)))[0]

    assert of(base) == of(base[::-1])
    others = [base[1:], [*base, ("x", 1)], [("x", 1), ("x", 1), ("y", 2), (None, None)], [("x", 1), ("z", 1), ("y", None), (None, 2)], []]
    assert len({of(d) for d in [base, *others]}) == 1 + len(others)
    parts = [rows(base[:2], schema), rows(base[2:], schema)]
    one = fingerprints.table_fingerprint(parts[0]).union(fingerprints.table_fingerprint(parts[1])).agg(*fingerprints.merged())
    assert as_list(one)[0] == of(base)


def test_changed_members(rows):
    prints = "k string, n_rows bigint, hash_sum decimal(38,0), hash_xor bigint"
    new = rows([("a", 1, D(5), 7), ("b", 1, D(6), 7), (None, 1, D(1), 1), ("d", 1, D(1), 1)], prints)
    old = rows([("a", 1, D(5), 7), ("b", 1, D(6), 8), (None, 1, D(1), 1), ("c", 2, D(1), 1)], prints)
    assert as_set(fingerprints.changed_members(new, old, ["k"])) == {("b",), ("c",), ("d",)}


def test_rejects_are_stored_with_reasons_and_counted_once(spark, rows, tmp_path):
    from tallyhouse.plans import quality, rejects

    bronze = "transaction_id string, transaction_date string, transaction_time string, transaction_qty string, store_id string, store_location string, product_id string, unit_price string, product_category string, product_type string, product_detail string, ingestion_date string"
    good = ["t", "2023-01-01", "07:00:00", "2", "3", "L", "1", "4.50", "c", "t", "Latte", "2023-06-15"]
    data = [tuple(good)] * 3
    for at, value in ((0, None), (1, None), (3, None), (7, None), (3, "0"), (7, "-1.00"), (11, "2023-06-14")):
        data.append(tuple(value if i == at else v for i, v in enumerate(good)))
    table = rows(data, bronze)
    counts = rejects.write_lines(spark, table, str(tmp_path))
    assert dict(as_list(counts)) == {"kept": 3, **dict.fromkeys(staging.REJECTS, 1)}
    mapping = rows([], "pos_product_detail string, canonical_product_name string, size_code string, cost_required string, recipe_required string, product_group string")
    kept = rejects.kept_lines(spark, str(tmp_path), mapping)
    want = staging.stage_pos_lines(table, mapping)
    assert sorted(map(str, kept.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert rejects.rejected_lines(spark, str(tmp_path)).groupBy("reject_reason").count().count() == len(staging.REJECTS)
    gate = quality.gate_silver_parity({"pos_line_counts": counts, "stg_pos_transactions": kept})
    assert as_list(gate, "bronze_rows", "silver_rows") == [(9, 3)]
    assert as_list(quality.silver_retention({"pos_line_counts": counts.limit(0), "stg_pos_transactions": kept}), "bronze_rows") == [(0,)]
