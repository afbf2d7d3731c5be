"""One cube of sums behind all slicers of the dashboards, and a cube of order bitmaps behind distinct counts.

`kpi_cube` holds the additive parts of every measure per fact and level. A level names what its rows are split by: day or
month, store or all stores, item or all items (product category for sales, ingredient for waste and inventory; labor has
none). Each fact is scanned once: lines collapse to cells of day, store and item before they meet dimensions or levels.

A slice reads the coarsest level that can answer it: whole months from month rows, ragged ends of a date range from day
rows, stores and items only where they are filtered or shown. Ratios are formed from the sums of the slice.

`order_cube` makes counts of distinct orders add up: an order has a place in a bitmap, cells of the cube hold bitmaps, and
any union of cells is the bitwise or of theirs.
"""

from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import money, rate_or_zero, rounded_ratio
from tallyhouse.plans.kpis import labor_cost_status

CELL = ["day", "year_month", "store_name", "item"]
SALES, LABOR, WASTE, STOCK = "sales", "labor", "waste", "inventory"


def _total(column, places=2):
    return F.sum(column).cast(f"decimal(32,{places})").alias(column)


def _members(gold):
    """Days, stores and categories by surrogate key, each key once."""
    days = gold["dim_date"].groupBy("date_key").agg(F.min("full_date").alias("day"), F.min("year_month").alias("year_month"))
    stores = gold["dim_store"].groupBy("store_key").agg(F.min("store_name").alias("store_name"))
    items = gold["dim_product"].groupBy("product_key").agg(F.min("product_category").alias("item"))
    return days, stores, items


def _cells(gold, fact, keys, measures):
    """Sums of a fact per day, store and item: summed per surrogate keys first, then named by the dimensions."""
    days, stores, items = _members(gold)
    rows = gold[fact].groupBy("date_key", "store_key", *keys).agg(*measures)
    rows = rows.join(days, "date_key", "left").join(stores, "store_key", "left")
    if "product_key" in keys:
        rows = rows.join(items, "product_key", "left")
    elif "ingredient_name" in keys:
        rows = rows.withColumnRenamed("ingredient_name", "item")
    else:
        rows = rows.withColumn("item", F.lit(None).cast("string"))
    return rows.drop("date_key", "store_key", "product_key")


def _levelled(cells, aggregates, *, items=True, also=()):
    """Cells rolled up to every level, in one pass over them; `also` are columns that stay apart in all levels."""
    sets = [
        [*period, *store, *item, *also]
        for period in (["day", "year_month"], ["year_month"])
        for store in (["store_name"], [])
        for item in ((["item"], []) if items else ([],))
    ]
    kept = [c for c in CELL if items or c != "item"]
    split = {"day": ("day", "month"), "store_name": ("store", "all"), "item": ("item", "all")}
    names = [F.when(F.grouping(c) == 0, apart).otherwise(whole) if c in kept else F.lit(whole) for c, (apart, whole) in split.items()]
    rolled = cells.groupingSets(sets, *kept, *also).agg(*aggregates, F.concat_ws("_", *names).alias("level"))
    return rolled if items else rolled.withColumn("item", F.lit(None).cast("string"))


def build_cube(gold):
    """The sums of the four facts at every level."""
    sources = {
        SALES: ("fct_sales", ["product_key"], {"revenue": ("gross_revenue", 2), "gross_profit": ("gross_profit", 2)}),
        LABOR: ("fct_labor", [], {
            "labor_cost": ("total_labor_cost", 2), "labor_revenue": ("daily_revenue", 2), "hours_worked": ("total_hours_worked", 1),
        }),
        WASTE: ("fct_waste", ["ingredient_name"], {
            "waste_amount": ("waste_amount_usd", 4), "waste_qty": ("waste_qty", 4), "theoretical": ("theoretical_consumption", 4),
        }),
        STOCK: ("fct_inventory_snapshot", ["ingredient_name"], {
            "days_left": ("days_of_inventory_remaining", 2), "closing_stock": ("closing_stock", 2), "units_received": ("units_received", 2),
        }),
    }
    cube = None
    for name, (fact, keys, measures) in sources.items():
        sums = [F.sum(column).cast(f"decimal(32,{places})").alias(out) for out, (column, places) in measures.items()]
        totals = [_total(out, places) for out, (_, places) in measures.items()]
        if name == STOCK:
            sums += [
                F.count("days_of_inventory_remaining").alias("days_known"),
                F.count_if(F.col("stockout_risk_flag") == "HIGH").alias("stockout_high"),
            ]
            totals += [F.sum(c).alias(c) for c in ("days_known", "stockout_high")]
        rolled = _levelled(_cells(gold, fact, keys, sums), totals, items=bool(keys)).withColumn("fact", F.lit(name))
        cube = rolled if cube is None else cube.unionByName(rolled, allowMissingColumns=True)
    return cube


def _as_date(value):
    return date.fromisoformat(value) if isinstance(value, str) else value


def whole_months(first, last):
    """(first day, last day) of the whole months within a range of days, None without any."""
    start = first if first.day == 1 else (first.replace(day=1) + timedelta(days=32)).replace(day=1)
    after = last + timedelta(days=1)
    stop = after.replace(day=1) - timedelta(days=1)
    return (start, stop) if start <= stop else None


def slice_rows(cube, fact, *, stores=None, items=None, date_from=None, date_to=None, by=()):
    """Cube rows whose sums make up a slice, of the coarsest levels that can tell it.

    `by` are the columns the slice is shown by: day, year_month, store_name, item. Where a column is filtered or shown,
    rows without a member of it (a key no dimension knows) are left out, as an inner join to the dimension would.
    Filters on items do not apply to labor, and each other fact has its own kind of item.
    """
    by_store, by_item = stores is not None or "store_name" in by, items is not None or "item" in by
    place = f"{'store' if by_store else 'all'}_{'item' if by_item else 'all'}"
    day, month = f"day_{place}", f"month_{place}"
    level = F.col("level")
    first, last = _as_date(date_from), _as_date(date_to)
    within = F.lit(True)
    if first is not None:
        within = within & (F.col("day") >= F.lit(first))
    if last is not None:
        within = within & (F.col("day") <= F.lit(last))
    if "day" in by:
        picked = (level == day) & within
    elif first is None and last is None:
        picked = level == month
    else:
        # An open end takes whole months on that side.
        months = whole_months(first or date(1900, 1, 1), last or date(9999, 11, 30))
        if months is None:
            picked = (level == day) & within
        else:
            ragged, of_month = F.lit(False), F.lit(True)
            if first is not None:
                ragged = ragged | (F.col("day") < F.lit(months[0]))
                of_month = of_month & (F.col("year_month") >= months[0].strftime("%Y-%m"))
            if last is not None:
                ragged = ragged | (F.col("day") > F.lit(months[1]))
                of_month = of_month & (F.col("year_month") <= months[1].strftime("%Y-%m"))
            picked = ((level == month) & of_month) | ((level == day) & within & ragged)
    rows = cube.where(F.col("fact") == fact).where(level.isin(day, month)).where(picked)
    if stores is not None:
        rows = rows.where(F.col("store_name").isin(*stores))
    if items is not None:
        rows = rows.where(F.col("item").isin(*items))
    return rows.dropna(subset=list(by)) if by else rows


def _zero(column, places=2):
    return F.coalesce(money(F.sum(column), places, 24), F.lit(0).cast(f"decimal(24,{places})")).alias(column)


def sales(cube, *, by=(), **slicers):
    """Revenue, gross profit and gross margin of a slice."""
    margin = rate_or_zero(F.sum("gross_profit"), F.sum("revenue")).alias("gross_margin_rate")
    return slice_rows(cube, SALES, by=by, **slicers).groupBy(*by).agg(_zero("revenue"), _zero("gross_profit"), margin)


def labor(cube, *, by=(), **slicers):
    """Labor cost, its share of revenue with the status, and revenue per hour of a slice."""
    return (
        slice_rows(cube, LABOR, by=by, **slicers)
        .groupBy(*by)
        .agg(
            _zero("labor_cost"),
            _zero("labor_revenue"),
            rate_or_zero(F.sum("labor_cost"), F.sum("labor_revenue")).alias("labor_cost_rate"),
            _zero("hours_worked", 1),
            rate_or_zero(F.sum("labor_revenue"), F.sum("hours_worked"), 2).alias("revenue_per_labor_hour"),
        )
        .withColumn("labor_cost_status", labor_cost_status())
    )


def waste(cube, *, by=(), **slicers):
    """Waste amount, quantity and rate of a slice."""
    waste_rate = rate_or_zero(F.abs(F.sum("waste_qty")), F.sum("theoretical")).alias("waste_rate")
    return slice_rows(cube, WASTE, by=by, **slicers).groupBy(*by).agg(_zero("waste_amount", 4), _zero("waste_qty", 4), waste_rate)


def inventory(cube, *, by=(), **slicers):
    """Mean days of stock and units received of a slice; closing stock and HIGH risks on its last day."""
    mean_days = rounded_ratio(F.sum("days_left"), F.sum("days_known"), 2).alias("avg_days_inventory")
    whole = slice_rows(cube, STOCK, by=by, **slicers).groupBy(*by).agg(mean_days, _zero("units_received"))
    # The last day shows only in day rows.
    daily = slice_rows(cube, STOCK, by=[*by, "day"], **slicers)
    last = daily.where(F.col("day") == daily.select(F.max("day")).scalar())
    ends = last.groupBy(*by).agg(
        F.max("day").alias("snapshot_date"),
        _zero("closing_stock"),
        F.coalesce(F.sum("stockout_high"), F.lit(0)).cast("bigint").alias("stockout_high_count"),
    )
    return whole.join(ends, list(by), "left") if by else whole.crossJoin(F.broadcast(ends))


# --- distinct orders -----------------------------------------------------------------------------------------------

def build_order_cube(gold):
    """Bitmaps of the orders in every cell and level: columns of the cube, then home, bucket and bitmap.

    An order's home is the first day and store it was seen in; there it gets its number, so nothing is numbered over all
    rows and a bitmap of 32,768 places is well filled. Orders without an id do not count, as in a count of distinct ids.
    """
    days, stores, items = _members(gold)
    lines = gold["fct_sales"].where(F.col("transaction_id").isNotNull())
    lines = lines.select("transaction_id", "date_key", "store_key", "product_key").distinct()
    cells = F.collect_set(F.struct("date_key", "store_key", "product_key")).alias("cells")
    orders = lines.groupBy("transaction_id").agg(F.min(F.struct("date_key", "store_key")).alias("home"), cells)
    code = (F.row_number().over(Window.partitionBy("home").orderBy("transaction_id")) - 1).cast("bigint")
    orders = orders.withColumn("code", code).select(
        "home", F.bitmap_bucket_number("code").alias("bucket"), F.bitmap_bit_position("code").alias("place"), F.explode("cells").alias("cell"),
    )
    named = (
        orders.select("home", "bucket", "place", "cell.*")
        .join(days, "date_key", "left").join(stores, "store_key", "left").join(items, "product_key", "left")
    )
    bitmaps = named.groupBy(*CELL, "home", "bucket").agg(F.bitmap_construct_agg("place").alias("orders"))
    return _levelled(bitmaps, [F.bitmap_or_agg("orders").alias("orders")], also=("home", "bucket")).withColumn("fact", F.lit(SALES))


def distinct_orders(order_cube, *, by=(), **slicers):
    """Exact number of distinct orders of a slice: bitmaps are merged per home, then their bits counted."""
    rows = slice_rows(order_cube, SALES, by=by, **slicers)
    merged = rows.groupBy(*by, "home", "bucket").agg(F.bitmap_or_agg("orders").alias("orders"))
    counted = merged.withColumn("n", F.bitmap_count("orders"))
    return counted.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orders"))


def order_values(cube, order_cube, *, by=(), **slicers):
    """Orders, revenue and revenue per order of a slice."""
    revenue = sales(cube, by=by, **slicers).select(*by, "revenue")
    counts = distinct_orders(order_cube, by=by, **slicers)
    both = revenue.join(counts, list(by)) if by else revenue.crossJoin(F.broadcast(counts))
    return both.withColumn("average_order_value", rate_or_zero("revenue", "orders", 2))
