"""Product-name text helpers."""

from pyspark.sql import functions as F

# Fixed value: size suffixes at the end of a product name.
SIZE_SUFFIX = " +(Sm|Rg|Lg)$"


def without_size(name):
    """Product name with a trailing size code removed."""
    return F.trim(F.regexp_replace(name, SIZE_SUFFIX, ""))


def size_code(name):
    """The trailing size code, or NULL."""
    return F.nullif(F.regexp_extract(name, SIZE_SUFFIX, 1), F.lit(""))


def header_name(name):
    """Header text as a column name: stripped, lower case, blanks as underscores."""
    return name.strip().lower().replace(" ", "_")


def hour_of(time, lenient=False):
    """Hour from `HH:MM:SS`. A time without the leading zero fails, or gives NULL when lenient."""
    text = F.substring(time, 1, 2)
    return text.try_cast("int") if lenient else text.cast("int")
