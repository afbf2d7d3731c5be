"""Copies that skip what is equal, exports that prove themselves, and plans that run nothing while they are made."""

import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import as_list, as_set
from tallyhouse.operators import intervals, joins, ordered
from tallyhouse.sources import copying, gold

HEADER = "a,b\n"


def put(root, date, name, content):
    folder = Path(root, f"ingestion_date={date}")
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(content)


def contents(root, date):
    return sorted(p.read_bytes() for p in Path(root, f"ingestion_date={date}").glob("part-*"))


def test_files_are_copied_whole_and_equal_arrivals_left_alone(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    put(source, "2023-06-14", "one.csv", b"a,b\n1,\"x\ny\"\n2, \r\n")
    put(source, "2023-06-14", "two.csv", b"a,b\n3,\xff\xfe\xc3")
    put(source, "2023-06-14", "none.csv", b"")
    put(source, "2023-06-15", "one.csv", b"b,a\n9,8\n")
    dates = ["2023-06-14", "2023-06-15"]
    report = copying.copy_arrivals(spark, source, target, dates, dataset="d")
    assert as_set(report, "dataset", "ingestion_date", "file", "n_rows", "status") == {
        ("d", "2023-06-14", "one.csv", 4, "copied"), ("d", "2023-06-14", "two.csv", 2, "copied"),
        ("d", "2023-06-15", "one.csv", 2, "copied"),
    }
    # A last line without a line feed gains one; all other bytes are the same.
    assert contents(target, "2023-06-14") == sorted([b"a,b\n1,\"x\ny\"\n2, \r\n", b"a,b\n3,\xff\xfe\xc3\n"])
    before = {p: p.stat().st_mtime_ns for p in Path(target).rglob("part-*")}
    assert as_set(copying.copy_arrivals(spark, source, target, dates), "status") == {("same",)}
    assert before == {p: p.stat().st_mtime_ns for p in Path(target).rglob("part-*")}

    # One arrival changes: only its folder is replaced.
    put(source, "2023-06-15", "one.csv", b"b,a\n9,7\n")
    report = copying.copy_arrivals(spark, source, target, dates)
    assert as_set(report, "ingestion_date", "status") == {("2023-06-14", "same"), ("2023-06-15", "copied")}
    assert contents(target, "2023-06-15") == [b"b,a\n9,7\n"]
    kept = {p: t for p, t in before.items() if "2023-06-14" in str(p)}
    assert kept and all(p.stat().st_mtime_ns == t for p, t in kept.items())


def test_files_larger_than_a_piece_are_copied_line_by_line(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    bodies = [b"".join(b"%d,%d\n" % (number, i) for i in range(3000)) for number in range(3)]
    bodies.append(b"\xef\xbb\xbf" + bodies[0] + b"\r\n\n")
    for number, body in enumerate(bodies):
        put(source, "2023-06-14", f"{number}.csv", body)
    put(source, "2023-06-15", "one.csv", b"a\n")
    # A setting for this test only, so that small files are read in pieces.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    reads, reader = [], type(spark.read)
    text = reader.text
    try:
        reader.text = lambda self, *a, **k: reads.append(k.get("wholetext")) or text(self, *a, **k)
        copying.copy_arrivals(spark, source, target, ["2023-06-14", "2023-06-15"])
    finally:
        reader.text = text
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert contents(target, "2023-06-14") == sorted(bodies) and contents(target, "2023-06-15") == [b"a\n"]
    # No task reads a file as one value.
    assert reads and not any(reads)


def test_a_file_that_does_not_arrive_fails(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    put(source, "2023-06-14", "one.csv", b"a,b\n1,2\n")
    put(source, "2023-06-14", "two.csv", b"a,b\n3,4\n")
    copy = copying._copy_files

    def lossy(spark, source, target, dates):
        copy(spark, source, target, dates)
        [first, *_] = sorted(p for p in Path(target).rglob("part-*") if b"3,4" in p.read_bytes())
        first.unlink()
        shutil.rmtree(first.parent / "x", ignore_errors=True)

    monkeypatch.setattr(copying, "_copy_files", lossy)
    report = copying.copy_arrivals(spark, source, target, ["2023-06-14"])
    assert as_set(report, "file", "status") == {("one.csv", "copied"), ("two.csv", "failed")}
    with pytest.raises(copying.CopyFailed, match="1 file"):
        copying.checked([report])


def test_export_manifest_has_fingerprints_and_checks_the_files(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, " a "), (2, 'say "x"\nand, y'), (3, None), (3, "")], "k int, t string").repartition(3)
    manifest = gold.export_snapshot({"fct_labor": df}, str(tmp_path), snapshot_id="s", tables=("fct_labor",))
    stored = json.loads((tmp_path / "s" / "manifest.json").read_text())["tables"]
    assert stored == manifest["tables"] and stored[0]["rows"] == 4
    again = gold.export_snapshot({"fct_labor": df.coalesce(1)}, str(tmp_path), snapshot_id="t", tables=("fct_labor",))["tables"][0]
    assert (again["hash_sum"], again["hash_xor"]) == (stored[0]["hash_sum"], stored[0]["hash_xor"])
    parts, calls = gold._text_parts, []
    # The files are read back as if they held other rows.

    def other_rows(columns):
        calls.append(columns)
        return parts(columns if len(calls) == 1 else columns[:1])

    monkeypatch.setattr(gold, "_text_parts", other_rows)
    with pytest.raises(gold.ExportIncomplete):
        gold.export_snapshot({"fct_labor": df}, str(tmp_path), snapshot_id="u", tables=("fct_labor",))
    assert not (tmp_path / "u" / "manifest.json").exists()


def test_nothing_runs_while_plans_are_made(spark, tmp_path):
    spark.range(200).select(
        (F.col("id") % 5).alias("k"), F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("d"),
        F.col("id").cast("decimal(12,2)").alias("v"), F.lit(1).cast("decimal(12,2)").alias("w"), F.lit("x").alias("unused"),
    ).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    costs = df.select("k", F.col("d").alias("valid_from"), F.date_add("d", 3).alias("valid_to"), F.col("v").alias("cost"))
    context = spark.sparkContext
    context.setJobGroup("planning", "plans only")
    try:
        plans = [
            ordered.number_lines(df, ["k"], ["v"]),
            ordered.trailing_avg(df, ["k"], "d", "v"),
            ordered.rank_by(df, "v"),
            ordered.carry_forward(df, ["k"], "d", 5, "v", "w"),
            joins.lookup_join(df, costs.select("k", "cost"), ["k"]),
            intervals.join_valid_indexed(df, costs, key="k", date_col="d"),
        ]
        assert list(context.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # A lookup reads the columns it needs.
    narrow = plans[4].select("cost")
    scans = [line for line in narrow._jdf.queryExecution().executedPlan().toString().split("\n") if "ReadSchema" in line]
    assert scans and not any("unused" in line or "d:date" in line for line in scans)
    assert all(len(as_list(plan)) >= 200 for plan in plans[:3])
