"""Small hand-made cases for the operators' edges."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import as_list, as_set
from tallyhouse.functions.calendar import calendar_columns, covered_days, date_spine
from tallyhouse.functions.keys import surrogate_key
from tallyhouse.functions.numbers import mean, percent, rate_or_zero, ratio
from tallyhouse.functions.text import hour_of, size_code, without_size
from tallyhouse.operators import constraints, joins, ordered, snapshot, staging

D = Decimal
DAY = dt.date


def test_latest_snapshot_keeps_only_the_greatest_date(rows):
    df = rows([(1, "2023-06-14"), (2, "2023-06-15"), (3, "2023-06-15")], "id int, ingestion_date string")
    assert as_set(snapshot.latest_snapshot(df), "id") == {(2,), (3,)}


def test_latest_snapshot_of_an_empty_table_is_empty(rows):
    assert snapshot.latest_snapshot(rows([], "id int, ingestion_date string")).count() == 0


def test_oldest_of_latest_is_null_when_one_side_is_empty(rows):
    some = rows([("2023-06-14",), ("2023-06-15",)], "ingestion_date string")
    older = rows([("2023-06-13",)], "ingestion_date string")
    none = rows([], "ingestion_date string")
    assert as_list(snapshot.oldest_of_latest(some, older)) == [("2023-06-13",)]
    assert as_list(snapshot.oldest_of_latest(some, none)) == [(None,)]


def test_hour_strict_and_lenient(rows):
    df = rows([("07:05:00",), ("7:05:00",)], "t string")
    assert as_list(df.select(hour_of(F.col("t"), lenient=True))) == [(7,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(hour_of(F.col("t"))).collect()


MAPPING = "pos_product_detail string, canonical_product_name string, size_code string, " \
          "cost_required boolean, recipe_required boolean, product_group string"


def test_canonicalise_defaults(rows):
    lines = rows([("Latte Lg",), ("Mug",), ("New thing",)], "product_name_raw string")
    mapping = rows(
        [("Latte Lg", "Latte", "Lg", True, True, "beverage"), ("Mug", "Mug", None, False, False, "merchandise")], MAPPING
    )
    out = joins.canonicalise(lines, mapping)
    got = as_set(out, "product_name_raw", "product_name", "size_code", "cost_required", "recipe_required", "product_group")
    assert got == {
        ("Latte Lg", "Latte", "Lg", True, True, "beverage"),
        ("Mug", "Mug", None, False, False, "merchandise"),
        ("New thing", "New thing", None, True, True, "unclassified"),
    }


def test_stage_mapping_trims_and_nulls_blank_sizes(rows):
    seed = rows([(" A ", " B ", " ", "true", "FALSE", " g ")], ", ".join(f"{c} string" for c in staging.schemas.MAPPING))
    assert as_list(staging.stage_mapping(seed)) == [("A", "B", None, True, False, "g")]


COSTS = "product_name string, unit_cost decimal(10,4), valid_from date, valid_to date"


def test_validity_bounds_belong_to_the_interval(rows):
    lines = rows([("a", DAY(2023, 1, 1)), ("a", DAY(2023, 1, 31)), ("a", DAY(2023, 2, 1))], "product_name string, transaction_date date")
    costs = rows([("a", D(2), DAY(2023, 1, 1), DAY(2023, 1, 31))], COSTS)
    got = dict(as_list(joins.join_valid(lines, costs), "transaction_date", "unit_cost"))
    assert got == {DAY(2023, 1, 1): D(2), DAY(2023, 1, 31): D(2), DAY(2023, 2, 1): None}


def test_overlapping_validity_duplicates_lines(rows):
    lines = rows([("a", DAY(2023, 1, 5))], "product_name string, transaction_date date")
    costs = rows([("a", D(2), DAY(2023, 1, 1), DAY(2023, 1, 31)), ("a", D(3), DAY(2023, 1, 5), DAY(2023, 2, 1))], COSTS)
    assert as_set(joins.join_valid(lines, costs), "unit_cost") == {(D(2),), (D(3),)}


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("null_safe", [True, False])
def test_lookup_is_the_same_with_and_without_broadcast(spark, rows, how, null_safe):
    keys = [random.Random(7).choice(["hot", "hot", "hot", "b", "c", None]) for _ in range(300)]
    facts = rows([(k, i) for i, k in enumerate(keys)], "k string, i int")
    table = rows([("hot", 1), ("hot", 2), ("b", 3), (None, 4)], "k string, v int")
    out, setting = joins.lookup_join(facts, table, ["k"], how, null_safe=null_safe), "spark.sql.autoBroadcastJoinThreshold"
    small = sorted(map(str, out.collect()))
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        again = joins.lookup_join(facts, table, ["k"], how, null_safe=null_safe)
        assert again.columns == out.columns and sorted(map(str, again.collect())) == small
    finally:
        spark.conf.set(setting, before)
    counts = Counter(keys)
    nulls = counts[None] if null_safe else 0
    matched = counts["hot"] + counts["b"] + nulls
    want = {"left_semi": matched, "left_anti": 300 - matched, "inner": matched + counts["hot"], "left": 300 + counts["hot"]}
    assert len(small) == want[how]


def test_missing_in_ignores_null_keys(rows):
    child = rows([(1,), (2,), (None,)], "k int")
    parent = rows([(1,), (1,)], "p int")
    assert as_list(joins.missing_in(child, parent, {"k": "p"})) == [(2,)]


def test_explode_bom_drops_products_without_recipe(rows):
    sales = rows([("Latte", 2), ("Mug", 1)], "product_name string, total_qty_sold long")
    bom = rows([("Latte", "milk", D(180)), ("Latte", "shot", D(60))], "product_name string, ingredient_name string, q decimal(10,4)")
    assert as_set(joins.explode_bom(sales, bom), "product_name", "ingredient_name") == {("Latte", "milk"), ("Latte", "shot")}


def brute_numbers(data, order):
    """Numbers per group by plain sorting, NULLs last; ties get a set of numbers."""
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    out = []
    for rows_ in groups.values():
        rows_.sort(key=lambda r: [(r[i] is None, r[i] if r[i] is not None else 0) for i in order])
        out += [(r, n) for n, r in enumerate(rows_, 1)]
    return sorted(map(str, out))


@pytest.mark.parametrize("limit", [1_000, 5, 1])
def test_line_numbers_of_large_groups_equal_sorting(rows, limit, monkeypatch):
    monkeypatch.setattr(ordered, "COPIES_PER_TASK", 3)
    rng = random.Random(3)
    data = [
        (rng.choice(["t1", "t1", "t1", "t2", None]), rng.choice([1, 2, None]), rng.choice([5, 6]), 0)
        for _ in range(120)
    ]
    df = rows(data, "t string, p int, q int, z int")
    out = ordered.number_lines(df, ["t"], ["p", "q"], name="n", max_group_rows=limit)
    got = sorted(str((tuple(r)[:4], r.n)) for r in out.collect())
    assert got == brute_numbers(data, [1, 2])


def test_trailing_mean_counts_records_not_days(rows):
    days = [DAY(2023, 1, d) for d in (1, 2, 3, 4, 5, 6, 20, 21)]
    df = rows([(1, d, D(i)) for i, d in enumerate(days, 1)], "k int, day date, v decimal(12,2)")
    got = dict(as_list(ordered.trailing_avg(df, ["k"], "day", "v"), "day", "trailing_avg"))
    assert got[DAY(2023, 1, 1)] == 1
    assert got[DAY(2023, 1, 20)] == 4  # 1..7
    assert got[DAY(2023, 1, 21)] == 5  # 2..8


@pytest.mark.parametrize("block", [1_000, 10, 7])
def test_trailing_mean_of_long_series_equals_plain(rows, monkeypatch, block):
    monkeypatch.setattr(ordered, "BLOCK_ROWS", block)
    rng = random.Random(2)
    start = DAY(2023, 1, 1)
    data = [(k, start + dt.timedelta(days=2 * i), D(rng.randrange(100))) for k in (1, 2) for i in range(45 if k == 1 else 4)]
    df = rows(data, "k int, day date, v decimal(12,2)")
    plain = ordered.trailing_avg(df, ["k"], "day", "v")
    split = ordered.trailing_avg(df, ["k"], "day", "v", max_group_rows=5)
    assert split.columns == plain.columns
    assert as_set(split) == as_set(plain) and split.count() == 49


def test_roll_forward_equals_the_fold(rows):
    rng = random.Random(5)
    data = [
        (k, DAY(2023, 1, 1) + dt.timedelta(days=i), D(rng.choice([0, 0, 40])), D(rng.randrange(0, 30)))
        for k in range(4) for i in range(60)
    ]
    out = ordered.roll_forward(rows(data, "k int, day date, r decimal(12,2), c decimal(12,2)"), ["k"], "day", 50, "r", "c")
    got = {(k, d): (o, c) for k, d, o, c in as_list(out, "k", "day", "opening_stock", "closing_stock")}
    clamped = 0
    for k in range(4):
        stock = D(50)
        for _, d, r, c in [x for x in data if x[0] == k]:
            closing = max(D(0), stock + r - c)
            clamped += stock + r - c < 0
            assert got[k, d] == (stock, closing)
            stock = closing
    assert clamped > 5


def test_period_growth(rows):
    df = rows([("2023-01", D(100)), ("2023-02", D(150)), ("2023-04", D(0)), ("2023-05", D(9))], "m string, v decimal(12,2)")
    got = as_list(ordered.period_growth(df, "m", "v").orderBy("m"), "growth_pct")
    assert got == [(None,), (D(50),), (D(-100),), (None,)]


@pytest.mark.parametrize("parts", [1, 3, 200])
def test_rank_equals_sorting(rows, parts):
    rng = random.Random(11)
    values = [D(rng.choice([-50, -3, 0, 0, 0, 7, 7, 1000, 1001, 1002, 10**9])) for _ in range(80)] + [None, None]
    df = rows(list(enumerate(values)), "i int, v decimal(14,2)")
    got = dict(as_list(ordered.rank_by(df, "v", parts=parts), "i", "rank"))
    present = [v for v in values if v is not None]
    for i, v in enumerate(values):
        assert got[i] == (1 + sum(o > v for o in present) if v is not None else 1 + len(present))


def test_surrogate_key_marks_null(rows):
    import hashlib

    df = rows([("a", None, 3)], "x string, y string, z int").select(surrogate_key("x", "y", "z").alias("k"))
    assert df.first().k == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-3").hexdigest()


def test_ratios_round_half_up_and_handle_zero(rows):
    df = rows([(D("1.005"), D(1)), (D(1), D(0)), (None, D(1)), (D(-1), D(8))], "a decimal(10,3), b decimal(10,3)")
    got = as_list(df.select(percent("a", "b"), rate_or_zero("a", "b", 2), ratio("a", "b").isNull()))
    assert got == [
        (D("100.50"), D("1.01"), False), (None, D(0), True), (None, D(0), True), (D("-12.50"), D("-0.13"), False)
    ]


def test_mean_ignores_null(rows):
    assert rows([(D(1),), (D(2),), (None,)], "a decimal(10,2)").agg(mean("a").alias("m")).first().m == D("1.50")


def test_text_helpers(rows):
    df = rows([("Latte  Lg",), ("Large",), (" Mug Rg",)], "n string")
    assert as_list(df.select(without_size(F.col("n")), size_code(F.col("n")))) == [("Latte", "Lg"), ("Large", None), ("Mug", "Rg")]


def test_calendar(spark, rows):
    spine = date_spine(spark, "2023-01-01", "2023-07-01")
    days = spine.select(*calendar_columns()).orderBy("date_key").collect()
    assert len(days) == 181
    first = days[0]
    assert (first.date_key, first.week_num, first.day_of_week_num, first.day_of_week_name, first.is_weekend) == (
        20230101, 52, 7, "Sunday", True,
    )
    gaps = rows([(DAY(2023, 1, 1),), (DAY(2023, 1, 4),)], "d date")
    assert covered_days(gaps, "d").count() == 4
    assert covered_days(gaps.where("false"), "d").count() == 0


def bronze_line(**changes):
    line = {
        "transaction_id": "1", "transaction_date": "2023-01-02", "transaction_time": "07:05:00", "transaction_qty": "2",
        "store_id": "3", "store_location": " Astoria ", "product_id": "9", "unit_price": "3.50", "product_category": "Coffee",
        "product_type": "Espresso", "product_detail": " Latte Lg ", "ingestion_date": "2023-06-15",
    }
    return line | changes


def test_stage_pos_rejects_and_numbers(spark, rows):
    lines = [
        bronze_line(), bronze_line(product_id="7"), bronze_line(transaction_qty="0"), bronze_line(unit_price="0"),
        bronze_line(transaction_id=None), bronze_line(transaction_date=None), bronze_line(transaction_qty=None),
        bronze_line(unit_price=None), bronze_line(ingestion_date="2023-06-01"),
    ]
    schema = ", ".join(f"{c} string" for c in lines[0])
    bronze = spark.createDataFrame([tuple(x.values()) for x in lines], schema)
    out = staging.stage_pos(bronze, rows([], MAPPING))
    assert out.columns == staging.STAGED_POS
    assert as_set(out, "product_id", "transaction_line_number", "gross_revenue", "product_name", "transaction_hour") == {
        (7, 1, D("7.00"), "Latte Lg", 7), (9, 2, D("7.00"), "Latte Lg", 7),
    }


def test_stage_costs_limits(rows):
    text = ", ".join(f"{c} string" for c in [*staging.schemas.COSTS, "ingestion_date"])
    base = ("2023-01-01", "2023-12-31", "ERP", "2023-06-15")
    data = [
        ("equal", "c", "2.00", "2.0000", "1.0", *base), ("above", "c", "2.00", "2.0001", "1.0", *base),
        ("zero", "c", "2.00", "0", "0", *base), ("free", "c", "0", "1", "0", *base),
    ]
    assert as_set(staging.stage_costs(rows(data, text)), "product_name") == {("equal",)}


def test_promotions_keep_every_load_unless_latest(rows):
    text = ", ".join(f"{c} string" for c in [*staging.schemas.PROMOTIONS, "ingestion_date"])
    promo = ("P1", "Deal", "fixed", "1", "Tea", "2023-01-01", "2023-02-01", "Mon,Tue", "all_day", "CRM")
    df = rows([(*promo, "2023-06-14"), (*promo, "2023-06-15")], text)
    assert staging.stage_promotions(df).count() == 2
    assert staging.stage_promotions(df, latest=True).count() == 1


def test_constraints(rows):
    df = rows([(1, "a", 5), (1, "b", 500), (None, "z", None)], "k int, s string, v int")
    assert as_list(constraints.unique(df, "k")) == [(1, 2)]
    assert constraints.not_null(df, "k").count() == 1
    assert as_list(constraints.accepted_values(df, "s", ["a", "b"])) == [("z", 1)]
    assert as_list(constraints.accepted_range(df, "v", 1, 100), "v") == [(500,)]
    assert constraints.accepted_range(df, "v", low=1).count() == 0
    parent = rows([(2,)], "id int")
    assert constraints.relationships(df, "k", parent, "id").count() == 2


def test_tied_rows_are_numbered_alike_whatever_the_group_limit(rows):
    df = rows([("t", "07:00", s, s % 3) for s in (9, 4, 7, 5, 8, 6)], "id string, at string, store int, v int")
    seen = {
        limit: sorted(tuple(r) for r in ordered.number_lines(df, ["id"], ["at"], max_group_rows=limit).select("store", "transaction_line_number").collect())
        for limit in (1, 2, 10, 1_000_000)
    }
    assert len({tuple(v) for v in seen.values()}) == 1 and seen[1][0] == (4, 1)
    means = {
        limit: sorted(tuple(r) for r in ordered.trailing_avg(df, ["id"], "at", "store", 3, max_group_rows=limit).select("store", "trailing_sum").collect())
        for limit in (1, 2, 10, 1_000_000)
    }
    assert len({tuple(v) for v in means.values()}) == 1


def test_numbering_deals_ordinary_groups_once(rows):
    plan = ordered.number_lines(rows([("t", 1, 2)], "t string, a int, z int"), ["t"], ["a"])._jdf.queryExecution().executedPlan()
    before_join = plan.toString().split("LeftAnti")[0]
    # The window is dealt by the very value that the join below it is dealt by.
    assert "Window" in before_join and "Exchange" not in before_join
