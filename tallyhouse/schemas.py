"""Column lists of the Bronze datasets and the types staging casts them to.

Bronze is text. Each dataset maps a column to its staging type; the order is
the order of the files.
"""

from pyspark.sql.types import StringType, StructField, StructType

ARRIVAL = "ingestion_date"

# Dataset names, columns and types.
POS = {
    "transaction_id": "string",
    "transaction_date": "date",
    "transaction_time": "string",
    "transaction_qty": "int",
    "store_id": "int",
    "store_location": "string",
    "product_id": "int",
    "unit_price": "decimal(10,2)",
    "product_category": "string",
    "product_type": "string",
    "product_detail": "string",
}
LINEAGE = {"ingestion_timestamp": "string", "source_file": "string"}
COSTS = {
    "product_name": "string",
    "product_category": "string",
    "unit_price_std": "decimal(10,2)",
    "unit_cost": "decimal(10,4)",
    "cogs_pct": "decimal(6,4)",
    "valid_from": "date",
    "valid_to": "date",
    "source_system": "string",
}
BOM = {
    "product_name": "string",
    "ingredient_name": "string",
    "qty_required_per_unit": "decimal(10,4)",
    "unit_of_measure": "string",
    "ingredient_cost_per_unit": "decimal(10,6)",
    "last_updated": "date",
}
INVENTORY = {
    "inventory_date": "date",
    "store_id": "int",
    "store_name": "string",
    "ingredient_name": "string",
    "opening_stock": "decimal(12,2)",
    "units_received": "decimal(12,2)",
    "actual_consumed": "decimal(12,2)",
    "closing_stock": "decimal(12,2)",
}
SHIFTS = {
    "shift_date": "date",
    "store_id": "int",
    "store_name": "string",
    "shift_type": "string",
    "shift_start": "string",
    "shift_end": "string",
    "employees_on_shift": "int",
    "hours_per_employee": "decimal(4,1)",
    "total_hours": "decimal(6,1)",
    "hourly_rate_usd": "decimal(6,2)",
    "labor_cost_usd": "decimal(10,2)",
}
PROMOTIONS = {
    "promotion_id": "string",
    "promotion_name": "string",
    "discount_type": "string",
    "discount_value": "decimal(10,2)",
    "applicable_category": "string",
    "start_date": "date",
    "end_date": "date",
    "applicable_days": "string",
    "applicable_hours": "string",
    "source_system": "string",
}
MAPPING = {
    "pos_product_detail": "string",
    "canonical_product_name": "string",
    "size_code": "string",
    "cost_required": "boolean",
    "recipe_required": "boolean",
    "product_group": "string",
}

# name -> (folder below the Bronze root, columns, partitioned by arrival date)
BRONZE = {
    "bronze_pos_transactions": ("pos/transactions", {**POS, **LINEAGE}, True),
    "bronze_product_costs": ("synthetic/product_costs", COSTS, True),
    "bronze_recipes_bom": ("synthetic/recipes_bom", BOM, True),
    "bronze_daily_inventory": ("synthetic/daily_inventory", INVENTORY, True),
    "bronze_staff_shifts": ("synthetic/staff_shifts", SHIFTS, True),
    "bronze_promotions": ("synthetic/promotions", PROMOTIONS, False),
}

GOLD_TABLES = (
    "fct_sales",
    "fct_waste",
    "fct_labor",
    "fct_inventory_snapshot",
    "dim_date",
    "dim_store",
    "dim_product",
    "dim_ingredient",
)


def text_schema(columns):
    """The all-string schema of a Bronze dataset."""
    return StructType([StructField(name, StringType()) for name in columns])
