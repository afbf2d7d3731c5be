"""Order-dependent operators: numbering, trailing means, roll-forward, growth, ranks.

A window sends each group to one task. Where a group has no natural bound
(lines of one transaction id, records of one series, all products) the operator
splits it; where the calendar bounds it (daily sums of one series, months) it
does not.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import rounded_ratio
from tallyhouse.operators.joins import lookup_join

MAX_GROUP_ROWS = 1_000_000
COPIES_PER_TASK = 100_000
BLOCK_ROWS = 100_000
RANK_PARTS = 200
CARRY_DAYS = 64


def _together(keys):
    """The keys as one value, which equals another where both hold the same NULLs: joins and windows are dealt alike by it."""
    return F.struct(*[F.col(k) for k in keys])


def split_large_groups(df, keys, max_group_rows=MAX_GROUP_ROWS):
    """Rows of ordinary groups and rows of groups above the limit, both with `_group` and both as plans; nothing runs here.

    Group sizes come from one narrow aggregate. Without large groups the second plan turns out empty while it runs, and the
    adaptive planner leaves out all that would follow. Rows are dealt by `_group`, once for both plans and for a window by it.
    """
    df = df.withColumn("_group", _together(keys))
    sizes = df.groupBy("_group").agg(F.count(F.lit(1)).alias("_rows"))
    large = sizes.where(F.col("_rows") > max_group_rows).select(F.col("_group").alias("_ref"))
    same = F.col("_group") == F.col("_ref")
    return df.join(large, same, "left_anti"), df.join(large, same, "left_semi")


def total_order(df, partition, order):
    """Sort columns: the named ones, then all others, NULLs last."""
    rest = [c for c in df.columns if c not in {*partition, *order}]
    return [F.asc_nulls_last(c) for c in [*order, *rest]]


def number_lines(df, partition, order, *, name="transaction_line_number", max_group_rows=MAX_GROUP_ROWS):
    """Number rows 1..n inside each group by the order columns, then by all others, NULLs last.

    The order is total: a number does not depend on partitions, retries or the
    size of a group. Groups above `max_group_rows` are numbered from counts
    instead of one sorted task.
    """
    plain, large = split_large_groups(df, partition, max_group_rows)
    over = Window.partitionBy("_group").orderBy(*total_order(df, partition, order))
    plain = plain.withColumn(name, F.row_number().over(over).cast("bigint")).drop("_group")
    return plain.unionByName(_number_large(large.drop("_group"), partition, order, name, max_group_rows))


def _number_large(df, partition, order, name, max_group_rows):
    """Numbering without a task that holds a whole group.

    Rows are dealt by their group and the first order column. Counts of that column's values tell how many rows of the group
    come before, and the rows of one value are numbered among themselves: in a window, or from counts where they are too many.
    """
    first, columns = order[0], df.columns
    keys = [*partition, first]
    rows = df.withColumn("_part", _together(keys))
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    parts = parts.withColumn("_group", F.struct(*[F.col(f"_part.`{k}`").alias(k) for k in partition]))
    over = Window.partitionBy("_group").orderBy(F.asc_nulls_last(f"_part.`{first}`")).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_part").alias("_ref"), "_rows", F.coalesce(F.sum("_rows").over(over), F.lit(0)).alias("_before"))
    same = F.col("_part") == F.col("_ref")
    plain = rows.join(parts.where(F.col("_rows") <= max_group_rows), same)
    large = rows.join(parts.where(F.col("_rows") > max_group_rows), same).select(*columns, "_before")
    over = Window.partitionBy("_part").orderBy(*(total_order(df, keys, order[1:]) or [F.lit(0)]))
    plain = plain.select(*columns, "_before", F.row_number().over(over).cast("bigint").alias(name))
    numbered = plain.unionByName(_number_counted(large, keys, order[1:], name))
    return numbered.select(*columns, (F.col(name) + F.col("_before")).alias(name))


def _number_counted(df, partition, order, name):
    """Numbering from counts.

    Identical rows collapse to a count before any shuffle. The rows ahead of a
    row are then added up one order column at a time: each window runs over the
    counts of one column's distinct values, not over rows.
    """
    runs = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    prefix, ahead = list(partition), None
    for column in order:
        over = Window.partitionBy(*prefix).orderBy(F.asc_nulls_last(column)).rowsBetween(Window.unboundedPreceding, -1)
        step = runs.groupBy(*prefix, column).agg(F.sum("_copies").alias("_n"))
        step = step.select(*prefix, column, F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_step"))
        if ahead is None:
            ahead = step.withColumnRenamed("_step", "_ahead")
        else:
            ahead = lookup_join(step, ahead, prefix, "inner", null_safe=True).withColumn(
                "_ahead", F.col("_ahead") + F.col("_step")
            ).drop("_step")
        prefix.append(column)
    runs = lookup_join(runs, ahead, prefix, "inner", null_safe=True) if order else runs.withColumn("_ahead", F.lit(0))
    rest = [c for c in df.columns if c not in prefix] or prefix
    over = Window.partitionBy(*prefix).orderBy(*[F.asc_nulls_last(c) for c in rest]).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_ahead") + F.coalesce(F.sum("_copies").over(over), F.lit(0))
    size = F.lit(COPIES_PER_TASK).cast("bigint")
    chunks = (
        runs.withColumn("_first", first)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / size))))
        .repartition("_first", "_chunk", *partition)
    )
    start = F.col("_chunk") * size
    numbers = F.sequence(F.col("_first") + start + 1, F.col("_first") + F.least(start + size, F.col("_copies")))
    return chunks.select(*df.columns, F.explode(numbers).alias(name))


def trailing_avg(df, keys, order, value, n=7, *, name="trailing_avg", total="trailing_sum", count="trailing_count",
                 max_group_rows=MAX_GROUP_ROWS):
    """Mean of the last `n` records (not days) of each series, with its exact sum and count.

    Series above `max_group_rows` are cut into blocks of numbered records. Each
    block also gets the last n - 1 records before it, so its means are complete.
    """
    plain, large = split_large_groups(df, keys, max_group_rows)

    def means(rows, groups, by):
        over = Window.partitionBy(*groups).orderBy(*by).rowsBetween(-(n - 1), 0)
        return rows.withColumns({total: F.sum(value).over(over), count: F.count(value).over(over)})

    out = means(plain, ["_group"], total_order(df, keys, [order])).drop("_group")
    # All of these series are large: they are numbered as such right away.
    numbered = _number_large(large.drop("_group"), keys, [order], "_n", max_group_rows)
    block = F.floor((F.col("_n") - 1) / BLOCK_ROWS)
    own = numbered.withColumns({"_block": block, "_own": F.lit(True)})
    tail = own.where(F.pmod(F.col("_n") - 1, F.lit(BLOCK_ROWS)) >= BLOCK_ROWS - (n - 1))
    blocks = own.unionByName(tail.withColumns({"_block": F.col("_block") + 1, "_own": F.lit(False)}))
    split = means(blocks, [*keys, "_block"], ["_n"]).where("_own").drop("_n", "_block", "_own")
    return out.unionByName(split).withColumn(name, rounded_ratio(total, count, 6))


def roll_forward(df, keys, order, opening, received, consumed, *, names=("opening_stock", "closing_stock")):
    """Stock per day: closing is opening plus receipts minus consumption, never below zero.

    Each opening is the previous closing; the first is `opening` (>= 0). The
    clamped recursion has a closed form, Lindley (1952): with S the running sum
    from the first opening, closing = S - min(0, lowest S so far). Movements are
    first summed per day, so a series is at most as long as the calendar.
    """
    daily = df.groupBy(*keys, order).agg(F.sum(received).alias(received), F.sum(consumed).alias(consumed))
    series = Window.partitionBy(*keys).orderBy(order)
    running = series.rowsBetween(Window.unboundedPreceding, 0)
    start = F.lit(opening).cast("decimal(24,2)")
    open_name, close_name = names
    change = (F.col(received) - F.col(consumed)).cast("decimal(24,2)")
    return (
        daily.withColumn("_s", start + F.sum(change).over(running))
        .withColumn("_low", F.min("_s").over(running))
        .withColumn(close_name, (F.col("_s") - F.least(F.lit(0), F.col("_low"))).cast("decimal(24,2)"))
        .withColumn(open_name, F.coalesce(F.lag(close_name).over(series), start))
        .drop("_s", "_low")
    )


def carry_forward(df, keys, order, opening, received, consumed, *, last=None, block_days=CARRY_DAYS,
                  names=("opening_stock", "closing_stock")):
    """Stock per day as `roll_forward` gives it, in blocks of days and carried on from stored closings.

    A day turns a stock x into max(0, x + change). Such steps compose: any run of days is x -> max(a, x + b), with b the sum of
    the changes and a what they leave of an empty stock. So each block of days is worked out by itself, one row per block and
    series tells where the next begins, and no task holds more than a block or a series of blocks. `last` holds keys, `order`
    (a date) and the closing column of days settled before: series go on from there, days up to it are left out, and series
    it doesn't know begin with `opening`.
    """
    open_name, close_name = names
    kind = "decimal(24,2)"
    daily = df.groupBy(*keys, order).agg(F.sum(received).alias(received), F.sum(consumed).alias(consumed))
    begin = F.lit(opening).cast(kind)
    if last is None:
        daily = daily.withColumn("_x", begin)
    else:
        known = last.select(*[F.col(k).alias(f"_{k}_ref") for k in keys], F.col(order).alias("_day"), F.col(close_name).alias("_x"))
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}_ref")) for k in keys])
        daily = daily.join(known, same, "left").where(F.col("_day").isNull() | (F.col(order) > F.col("_day")))
        daily = daily.withColumn("_x", F.coalesce(F.col("_x").cast(kind), begin)).drop("_day", *[f"_{k}_ref" for k in keys])
    days = daily.withColumn("_block", F.floor(F.unix_date(order) / F.lit(block_days)).cast("int"))
    block = Window.partitionBy(*keys, "_block").orderBy(order)
    running = block.rowsBetween(Window.unboundedPreceding, 0)
    change = (F.col(received) - F.col(consumed)).cast(kind)
    days = days.withColumn("_b", F.sum(change).over(running)).withColumn("_a", F.col("_b") - F.min("_b").over(running))
    blocks = days.groupBy(*keys, "_block").agg(F.max_by(F.struct("_a", "_b"), order).alias("_f"), F.min("_x").alias("_x"))
    series = Window.partitionBy(*keys).orderBy("_block")
    before = series.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_sum", F.sum("_f._b").over(series.rowsBetween(Window.unboundedPreceding, 0)))
    # The closed form over blocks: the sum so far, above the highest floor a block has set.
    start = F.coalesce(F.lag("_sum").over(series), F.lit(0)) + F.greatest("_x", F.max(F.col("_f._a") - F.col("_sum")).over(before))
    starts = blocks.select(*[F.col(k).alias(f"_{k}_ref") for k in keys], F.col("_block").alias("_own"), start.cast(kind).alias("_start"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}_ref")) for k in keys]) & (F.col("_block") == F.col("_own"))
    closing = F.greatest(F.col("_a"), F.col("_start") + F.col("_b")).cast(kind)
    return (
        days.join(starts, same)
        .withColumn(close_name, closing)
        .withColumn(open_name, F.coalesce(F.lag(close_name).over(block), "_start").cast(kind))
        .select(*keys, order, received, consumed, close_name, open_name)
    )


def closings(rolled, keys, order, closing="closing_stock"):
    """The last day of each series with its closing stock, for `carry_forward` to go on from."""
    return rolled.groupBy(*keys).agg(F.max(F.struct(order, closing)).alias("_l")).select(*keys, f"_l.{order}", f"_l.{closing}")


def period_growth(df, period, value, *, name="growth_pct"):
    """Percent change to the previous period present.

    The input is one row per calendar period, so the single window group is
    a few hundred rows at most.
    """
    over = Window.orderBy(period)
    before = F.lag(value).over(over)
    return df.withColumn("previous", before).withColumn(
        name, rounded_ratio((F.col(value) - F.col("previous")) * 100, "previous", 2)
    )


def rank_by(df, value, *, name="rank", parts=RANK_PARTS):
    """Rank by a value, highest first, ties sharing a rank, NULLs last; no task sees all rows.

    Equal values collapse to a count. Cut points from a quantile sketch deal the distinct values into `parts` ranges of
    nearly equal size, however the values lie; ranks are formed inside a range, and the rows of all higher ranges, a table
    of `parts` numbers, are added. The cut points only place the work: ranks don't depend on them.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = counts.agg(F.percentile_approx(value, shares, F.lit(parts * 50)).alias("_cuts"))
    higher = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut > F.col(value))), F.lit(0))
    counts = counts.crossJoin(F.broadcast(cuts)).withColumn("_part", F.when(F.col(value).isNull(), parts).otherwise(higher))
    above = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("_part").agg(F.sum("_n").alias("_n")).select(
        F.col("_part").alias("_own"), F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above")
    )
    within = Window.partitionBy("_part").orderBy(F.desc_nulls_last(value)).rowsBetween(Window.unboundedPreceding, -1)
    # At most `parts` + 1 rows.
    ranked = counts.join(F.broadcast(totals), F.col("_part") == F.col("_own")).select(
        F.col(value).alias("_value"),
        (F.lit(1) + F.col("_above") + F.coalesce(F.sum("_n").over(within), F.lit(0))).alias(name),
    )
    return df.join(ranked, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")
