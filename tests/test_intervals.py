"""The interval index against comparing all versions."""

import datetime as dt
import random

import pytest

from conftest import as_list
from tallyhouse.operators import intervals, joins
from tallyhouse.plans import dimensions

DAY = dt.date
START = DAY(2023, 1, 1)
COSTS = "product_name string, unit_cost int, valid_from date, valid_to date"
LINES = "line int, product_name string, transaction_date date"


def day(n):
    return START + dt.timedelta(days=n)


def random_costs(rng, n=200):
    out = []
    for i in range(n):
        first = rng.randrange(-20, 120)
        out.append((rng.choice("abc"), i, day(first), day(first + rng.choice([-3, 0, 0, 1, 5, 30, 90]))))
    return out + [("a", 900, None, day(5)), ("b", 901, day(5), None), (None, 902, day(1), day(2)), ("c", 903, DAY(1970, 1, 1), DAY(9999, 12, 31))]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    lines = [(i, rng.choice(["a", "a", "a", "b", "c", "d", None]), rng.choice([None, *map(day, range(110))])) for i in range(400)]
    return spark.createDataFrame(lines, LINES), spark.createDataFrame(random_costs(rng), COSTS)


def test_segments_are_disjoint_and_say_how_many_are_in_force(tables):
    _, costs = tables
    versions = [tuple(r) for r in costs.collect()]
    covered = {}
    for name, first, last, n in as_list(intervals.elementary_intervals(costs, ["product_name"])):
        assert first <= last
        for i in range(min((last - first).days + 1, 400)):
            key = name, first + dt.timedelta(days=i)
            assert key not in covered
            covered[key] = n
    for name in "abc":
        for n in range(-30, 150):
            want = sum(p == name and f is not None and t is not None and f <= day(n) <= t for p, _, f, t in versions)
            if name != "c" or want > 1:
                assert covered.get((name, day(n)), 0) == want
    crossing = intervals.overlaps(costs, ["product_name"])
    assert min(r.n_versions for r in crossing.collect()) == 2


@pytest.mark.parametrize("bin_days", [1, 8, 1000])
def test_indexed_join_equals_plain_join(tables, bin_days):
    lines, costs = tables
    got = intervals.join_valid_indexed(lines, costs, bin_days=bin_days)
    want = joins.join_valid(lines, costs)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_latest_version_keeps_the_number_of_lines(tables):
    lines, costs = tables
    versions = [tuple(r) for r in costs.collect()]
    got = {r.line: r for r in intervals.join_valid_indexed(lines, costs, latest=True).collect()}
    assert len(got) == lines.count() == 400
    for r in lines.collect():
        fitting = [(f, t, c) for p, c, f, t in versions if p == r.product_name and None not in (f, t, r.transaction_date) and f <= r.transaction_date <= t]
        assert got[r.line].unit_cost == (max(fitting)[2] if fitting else None)


def test_empty_sides(spark, tables):
    lines, costs = tables
    assert intervals.join_valid_indexed(lines.limit(0), costs).count() == 0
    assert intervals.join_valid_indexed(lines, costs.limit(0)).where("unit_cost is not null").count() == 0
    assert intervals.elementary_intervals(costs.limit(0), ["product_name"]).count() == 0


def test_product_versions_have_one_row_for_each_interval(spark, tables):
    _, costs = tables
    lines = spark.createDataFrame([(p, "cat", "type", "group") for p in "aabd"], "product_name string, product_category string, product_type string, product_group string")
    dim = dimensions.build_dim_product_versions(lines, costs)
    rows = dim.collect()
    assert len({r.version_key for r in rows}) == len(rows)
    assert [r.valid_from for r in rows if r.product_name == "d"] == [None]
    spans = sorted((r.valid_from, r.valid_to) for r in rows if r.product_name == "a")
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
