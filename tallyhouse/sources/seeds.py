"""The product-name mapping seed."""

from tallyhouse.operators.staging import stage_mapping
from tallyhouse.schemas import MAPPING, text_schema


def read_mapping(spark, path):
    """The mapping CSV, typed: trimmed text, blank as NULL, flags as booleans. Columns bind by name."""
    seed = spark.read.option("header", True).option("escape", '"').csv(str(path))
    return stage_mapping(seed.select(*text_schema(MAPPING).fieldNames()))
