"""Surrogate keys."""

from pyspark.sql import functions as F

# Fixed value: the marker that stands for NULL inside a key.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns):
    """md5 over the text of the columns joined by '-', with a marker for NULL."""
    parts = []
    for column in columns:
        column = F.col(column) if isinstance(column, str) else column
        parts.append(F.coalesce(column.cast("string"), F.lit(NULL_MARKER)))
    return F.md5(F.concat_ws("-", *parts))
