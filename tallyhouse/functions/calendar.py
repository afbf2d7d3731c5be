"""Calendar attributes and day series."""

from pyspark.sql import functions as F


def calendar_columns(day="full_date"):
    """The calendar attributes of a date column; weeks are ISO, Monday is day 1."""
    d = F.col(day)
    weekday = F.weekday(d) + 1
    return [
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("week_num"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week_num"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        weekday.isin(6, 7).alias("is_weekend"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    ]


def date_spine(spark, start, end_exclusive):
    """One row per day from `start` up to, not including, `end_exclusive`."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end_exclusive).cast("date").alias("stop")
    )
    return bounds.select(F.explode(F.sequence("first", F.date_sub("stop", 1))).alias("full_date"))


def covered_days(df, date_column):
    """One row per day between the first and the last date of a table, gaps included."""
    bounds = df.agg(F.min(date_column).alias("first"), F.max(date_column).alias("last"))
    return bounds.where("first is not null").select(F.explode(F.sequence("first", "last")).alias("full_date"))
