"""Landing, Bronze snapshots, Gold storage, export and the daily build on files."""

import json
import re
from pathlib import Path

import pytest

from conftest import as_list, as_set
from tallyhouse import schemas
from tallyhouse.plans import daily, generate, quality
from tallyhouse.sources import audit, bronze, gold, landing, seeds

HEADER = "Transaction ID, transaction_date,transaction_time,transaction_qty,store_id,Store Location ,product_id,unit_price,product_category,product_type,product_detail"
MENU = ["Latte Lg", "Croissant", "Earl Grey Lg", "Civet Cat", "I Need My Bean! T-shirt", "Espresso shot"]


def raw_csv(path, n=360, **changes):
    lines = [HEADER]
    for i in range(n):
        store = (3, 5, 8)[i % 3]
        row = {"id": f"t{i // 2}", "date": f"2023-06-{1 + i % 30:02d}", "qty": 1 + i % 3, "detail": MENU[i % len(MENU)]} | changes
        lines.append(f'{row["id"]}, {row["date"]},07:05:00,{row["qty"]},{store},"Loc, {store}",{i % 6},4.50,Coffee,Type,{row["detail"]}')
    Path(path).write_text("\n".join(lines) + "\n")


MAPPING = """pos_product_detail,canonical_product_name,size_code,cost_required,recipe_required,product_group,notes
Latte Lg,Latte,Lg,true,true,beverage_prepared,"size, large"
Croissant, Croissant ,,true,true,bakery_prepared,
Earl Grey Lg,Earl Grey,Lg,true,true,tea_prepared,
Civet Cat,Civet Cat,,true,false,retail_packaged,
"""


def test_choose_raw_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.choose_raw_file(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text("x")
    assert landing.choose_raw_file(spark, str(tmp_path)).endswith("/b.csv")
    (tmp_path / "a.csv").write_text("x")
    with pytest.raises(FileExistsError):
        landing.choose_raw_file(spark, str(tmp_path))
    (tmp_path / landing.PREFERRED_FILE).write_text("x")
    assert landing.choose_raw_file(spark, str(tmp_path)).endswith(landing.PREFERRED_FILE)


def test_raw_csv_binds_quotes_blanks_and_null_markers(spark, tmp_path):
    (tmp_path / "r.csv").write_text('Transaction ID, Product Detail,note\n1,"Mon,Tue",NA\n2,,x\n')
    df = landing.load_raw_pos(spark, tmp_path / "r.csv")
    assert df.columns == ["transaction_id", "product_detail", "note"]
    assert as_list(df) == [("1", "Mon,Tue", "NA"), ("2", None, "x")]
    assert as_list(landing.load_raw_pos(spark, tmp_path / "r.csv", null_markers=["NA"]), "note") == [(None,), ("x",)]


def test_landing_validation(spark, tmp_path):
    raw_csv(tmp_path / "ok.csv", 100)
    assert landing.validate_landing(landing.load_raw_pos(spark, tmp_path / "ok.csv"))["valid"]
    raw_csv(tmp_path / "few.csv", 99, id="")
    report = landing.validate_landing(landing.load_raw_pos(spark, tmp_path / "few.csv").drop("unit_price"))
    assert not report["valid"] and len(report["issues"]) == 3


def test_rejected_file_is_not_landed(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    raw_csv(tmp_path / "raw" / "x.csv", 5)
    with pytest.raises(landing.LandingRejected):
        landing.land_pos(spark, str(tmp_path / "raw"), str(tmp_path / "lake"), "2023-06-15")
    assert not (tmp_path / "lake").exists()


def test_rerun_replaces_its_own_arrival_only(spark, rows, tmp_path, capsys):
    root, name = str(tmp_path), "bronze_recipes_bom"
    make = lambda tag: rows([(tag, "milk", "1", "ml", "0.1", "2023-01-01")], ", ".join(f"{c} string" for c in schemas.BOM))
    for date, tag in (("2023-06-14", "a"), ("2023-06-15", "b"), ("2023-06-15", "c")):
        bronze.write_bronze(make(tag), root, name, date)
    df = bronze.read_bronze(spark, root, name)
    assert as_set(df, "product_name", "ingestion_date") == {("a", "2023-06-14"), ("c", "2023-06-15")}
    assert dict(df.dtypes)["ingestion_date"] == "string"
    assert bronze.latest_arrival(spark, bronze.dataset_path(root, name)) == "2023-06-15"
    latest = bronze.read_bronze(spark, root, name, latest=True)
    assert as_set(latest, "product_name") == {("c",)}
    latest.explain("formatted")
    assert re.search(r"PartitionFilters: \[.*ingestion_date#\d+ = 2023-06-15", capsys.readouterr().out)
    assert bronze.arrivals(spark, root, name) == ["2023-06-14", "2023-06-15"]


def test_columns_bind_by_header_not_by_position(spark, tmp_path):
    """A file whose own arrival column sits before the lineage columns does not shift them."""
    folder = tmp_path / "pos/transactions/ingestion_date=2023-06-15"
    folder.mkdir(parents=True)
    columns = [*reversed(schemas.POS), "ingestion_date", "ingestion_timestamp", "source_file"]
    values = [*[f"v_{c}" for c in reversed(schemas.POS)], "2023-06-15", "now", "raw.csv"]
    (folder / "x.csv").write_text(",".join(columns) + "\n" + ",".join(values) + "\n")
    row = bronze.read_bronze(spark, str(tmp_path), "bronze_pos_transactions").first()
    assert (row.transaction_id, row.product_detail, row.source_file, row.ingestion_timestamp, row.ingestion_date) == (
        "v_transaction_id", "v_product_detail", "raw.csv", "now", "2023-06-15",
    )


def test_copy_incremental_and_full(spark, rows, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    df = rows([("x", "milk", "1", "ml", "0.1", "2023-01-01")], ", ".join(f"{c} string" for c in schemas.BOM))
    for date in ("2023-06-14", "2023-06-15"):
        bronze.write_bronze(df, source, "bronze_recipes_bom", date)
    assert bronze.copy_bronze(spark, source, target, run_date="2023-06-15") == [("bronze_recipes_bom", "2023-06-15")]
    assert bronze.arrivals(spark, target, "bronze_recipes_bom") == ["2023-06-15"]
    assert len(bronze.copy_bronze(spark, source, target, full_refresh=True)) == 2
    assert bronze.read_bronze(spark, target, "bronze_recipes_bom").count() == 2
    with pytest.raises(FileNotFoundError):
        bronze.copy_bronze(spark, source, target, run_date="1999-01-01")
    with pytest.raises(ValueError, match="run_date"):
        bronze.copy_bronze(spark, source, target)
    status = dict(as_list(bronze.verify_arrivals(spark, target)))
    assert status == {n: n == "bronze_recipes_bom" for n in bronze.DATASETS}


def test_catalog_tables_and_repair(spark, rows, tmp_path):
    root = str(tmp_path)
    df = rows([("x", "milk", "1", "ml", "0.1", "2023-01-01")], ", ".join(f"{c} string" for c in schemas.BOM))
    bronze.write_bronze(df, root, "bronze_recipes_bom", "2023-06-14")
    bronze.create_bronze_tables(spark, root, "bronze_db")
    assert {t.name for t in spark.catalog.listTables("bronze_db")} == set(bronze.DATASETS)
    bronze.write_bronze(df, root, "bronze_recipes_bom", "2023-06-15")
    assert "bronze_promotions" not in bronze.repair_partitions(spark, "bronze_db")
    table = spark.table("bronze_db.bronze_recipes_bom")
    assert as_set(table, "product_name", "ingredient_cost_per_unit", "ingestion_date") == {
        ("x", "0.1", "2023-06-14"), ("x", "0.1", "2023-06-15"),
    }
    assert len(bronze.declared_columns()) == 61 and sum(p for *_, p in bronze.declared_columns()) == 5
    spark.sql("DROP DATABASE bronze_db CASCADE")


def test_find_complete_schema(spark, rows, tmp_path):
    root, df = str(tmp_path), rows([(1,)], "a int")
    gold.write_table(df, root, "t1", "half")
    for table in ("t1", "t2"):
        gold.write_table(df, root, table, "full")
    assert gold.find_complete_schema(spark, root, ["missing", "half", "full"], ("t1", "t2")) == "full"
    with pytest.raises(LookupError):
        gold.find_complete_schema(spark, root, ["half"], ("t1", "t2"))


def test_find_complete_database(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS bi_full")
    rows([(1,)], "a int").write.mode("overwrite").saveAsTable("bi_full.t1")
    assert gold.find_complete_database(spark, ["nowhere", "default", "bi_full"], ("t1",)) == "bi_full"
    with pytest.raises(LookupError):
        gold.find_complete_database(spark, ["default"], ("t1",))
    spark.sql("DROP DATABASE bi_full CASCADE")


def test_run_summary(spark, tmp_path):
    ok = audit.run_summary(spark, run_date="2023-06-15", run_id="r1", status="SUCCESS")
    bad = audit.run_summary(spark, run_date="2023-06-15", run_id="r2", status="FAILED", failed_tasks=["build", "export"])
    audit.write_run_summary(ok, str(tmp_path))
    audit.write_run_summary(bad, str(tmp_path))
    found = spark.read.json(str(tmp_path / "pipeline-runs"))
    assert as_list(found, "dag_run_id", "failed_task") == [("r2", "build")]
    assert ok.first().failed_tasks is None


def test_daily_run_end_to_end(spark, tmp_path):
    raw, root, lake, out = (str(tmp_path / n) for n in ("raw", "bronze", "lake", "bi"))
    Path(raw).mkdir()
    raw_csv(f"{raw}/pos.csv")
    (tmp_path / "mapping.csv").write_text(MAPPING)
    mapping = seeds.read_mapping(spark, tmp_path / "mapping.csv")
    assert as_set(mapping.where("pos_product_detail = 'Croissant'"), "canonical_product_name", "size_code") == {("Croissant", None)}
    assert landing.land_pos(spark, raw, root, "2023-06-15")["rows"] == 360
    written = generate.generate_all(spark, root, "2023-06-15")
    assert written["bronze_recipes_bom"] == 83 and written["bronze_daily_inventory"] == 5430
    tables = daily.run_daily(spark, root, mapping, lake, "2023-06-15", export_to=out)

    sales = tables["fct_sales"]
    assert sales.count() == 360 and sales.select("sales_key").distinct().count() == 360
    assert sales.where("gross_profit + cogs_amount <> gross_revenue").count() == 0
    assert sales.where("product_name = 'Latte' and unit_cost is null").count() == 0
    # Earl Grey is flagged for a recipe but has none: it drops out of consumption.
    assert as_set(tables["fct_waste"], "ingredient_name") == {("espresso_shot_ml",), ("whole_milk_ml",), ("flour_g",), ("butter_g",)}
    assert tables["fct_inventory_snapshot"].count() == 5430
    assert as_set(tables["dim_store"], "store_location") == {("Loc, 3",), ("Loc, 5",), ("Loc, 8",)}

    [folder] = Path(out).iterdir()
    manifest = json.loads((folder / "manifest.json").read_text())
    assert {t["table"]: t["rows"] for t in manifest["tables"]}["fct_sales"] == 360
    exported = spark.read.option("header", True).csv(str(folder / "fct_sales.csv"))
    assert exported.count() == 360 and exported.where("unit_cost is null").count() > 0
    assert as_list(spark.read.json(f"{lake}/pipeline-runs"), "status") == [("SUCCESS",)]
    assert spark.read.json(f"{lake}/quality-gate-results/results").where("status = 'FAIL'").count() > 0

    # A second arrival replaces the first in Gold; without its POS file the gates stop the run.
    landing.land_pos(spark, raw, root, "2023-06-16")
    generate.generate_all(spark, root, "2023-06-16")
    again = daily.run_daily(spark, root, mapping, lake, "2023-06-16")
    assert again["fct_sales"].count() == 360
    assert as_set(bronze.read_bronze(spark, root, "bronze_pos_transactions"), "ingestion_date") == {("2023-06-15",), ("2023-06-16",)}
    few = bronze.read_bronze(spark, root, "bronze_pos_transactions", latest=True).limit(10).drop("ingestion_date")
    bronze.write_bronze(few, root, "bronze_pos_transactions", "2023-06-17")
    with pytest.raises(quality.CriticalGateFailure):
        daily.run_daily(spark, root, mapping, lake, "2023-06-17")
    last = spark.read.json(f"{lake}/pipeline-runs").where("run_date = '2023-06-17'")
    assert as_list(last, "status", "failed_task") == [("FAILED", "quality_gates_pre")]


def test_arrivals_of_other_column_orders_bind_by_name(rows, tmp_path, spark):
    root = str(tmp_path / "bronze")
    first = rows([("a", "g", "1.5", "ml")], "product_name string, ingredient_name string, qty_required_per_unit string, unit_of_measure string")
    second = rows([("g", "ml", "b")], "ingredient_name string, unit_of_measure string, product_name string")
    bronze.write_bronze(first, root, "bronze_recipes_bom", "2023-06-14")
    bronze.write_bronze(second, root, "bronze_recipes_bom", "2023-06-15")
    wanted = ("product_name", "ingredient_name", "qty_required_per_unit", "unit_of_measure")
    assert as_set(bronze.read_bronze(spark, root, "bronze_recipes_bom"), *wanted) == {("a", "g", "1.5", "ml"), ("b", "g", None, "ml")}
    newest = bronze.read_bronze(spark, root, "bronze_recipes_bom", latest=True)
    assert as_set(newest, *wanted) == {("b", "g", None, "ml")}
    copied = str(tmp_path / "copy")
    bronze.copy_bronze(spark, root, copied, full_refresh=True)
    assert as_set(bronze.read_bronze(spark, copied, "bronze_recipes_bom"), *wanted) == {("a", "g", "1.5", "ml"), ("b", "g", None, "ml")}


def test_empty_rerun_empties_its_snapshot(rows, tmp_path, spark):
    root = str(tmp_path / "bronze")
    df = rows([("a", "g")], "product_name string, ingredient_name string")
    bronze.write_bronze(df, root, "bronze_recipes_bom", "2023-06-14")
    bronze.write_bronze(df.limit(0), root, "bronze_recipes_bom", "2023-06-14")
    assert bronze.read_bronze(spark, root, "bronze_recipes_bom").count() == 0


def test_gate_store_keeps_other_gates_and_clears_passed_ones(rows, tmp_path, spark):
    schema = "gate string, level string, status string, n_failures bigint, sample array<string>, run_date string"
    store = audit.gate_store(str(tmp_path / "gates"))
    store(rows([("01", "CRITICAL", "FAIL", 1, ["x"], "2023-06-15")], schema), {"01": rows([(1,)], "v int")})
    store(rows([("06", "WARNING", "PASS", 0, [], "2023-06-15")], schema), {})
    kept = spark.read.json(str(tmp_path / "gates" / "results"))
    assert {str(r.gate).lstrip("0") for r in kept.collect()} == {"1", "6"}
    store(rows([("01", "CRITICAL", "PASS", 0, [], "2023-06-15")], schema), {})
    assert list((tmp_path / "gates" / "failures").rglob("part-*.json")) == [] or all(
        p.stat().st_size == 0 for p in (tmp_path / "gates" / "failures").rglob("part-*.json")
    )
