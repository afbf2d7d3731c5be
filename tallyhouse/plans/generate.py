"""Generators of the five side datasets around a POS file.

Every generator expands DataFrames of entities (products, stores) inside Spark
and draws by hashed keys. The result does not repeat any particular numpy
stream; it has the same ranges and rules.
"""

from decimal import Decimal

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions.draws import uniform
from tallyhouse.operators.joins import lookup_join
from tallyhouse.schemas import PROMOTIONS
from tallyhouse.sources.bronze import write_bronze

SEED = 42
# The generated year and half-year.
VALID_FROM, VALID_TO = "2023-01-01", "2023-12-31"
FIRST_DAY, LAST_DAY = "2023-01-01", "2023-06-30"


def product_catalog(spark, products=fixed.PRODUCTS):
    return spark.createDataFrame(products, "product_name string, product_category string, cogs_share double")


def recipe_table(spark, recipes=None):
    """One row per product with a map from ingredient to amount."""
    rows = [(p, {k: Decimal(v) for k, v in r.items()}) for p, r in (recipes or fixed.RECIPES).items()]
    return spark.createDataFrame(rows, "product_name string, amounts map<string,decimal(10,4)>")


def store_table(spark, stores=fixed.STORES):
    return spark.createDataFrame([s[:2] for s in stores], "store_id int, store_name string")


def generate_product_costs(catalog, *, seed=SEED, valid_from=VALID_FROM, valid_to=VALID_TO):
    """Price from 3 to 8.5, cost around the product's usual share of it, one interval for the year."""
    drawn = catalog.select(
        "product_name",
        "product_category",
        F.col("cogs_share").cast("decimal(6,4)").alias("_share"),
        uniform("3.00", "8.50", 2, seed, "price", "product_name").alias("_price"),
        uniform("0.92", "1.08", 4, seed, "cost", "product_name").alias("_factor"),
    )
    cost = (F.col("_price") * F.col("_share") * F.col("_factor")).cast("decimal(10,2)")
    return drawn.withColumn("_cost", cost).select(
        "product_name",
        "product_category",
        F.col("_price").cast("decimal(10,2)").alias("unit_price_std"),
        F.col("_cost").alias("unit_cost"),
        F.round(F.col("_cost").cast("decimal(14,4)") / F.col("_price"), 4).cast("decimal(6,4)").alias("cogs_pct"),
        F.lit(valid_from).alias("valid_from"),
        F.lit(valid_to).alias("valid_to"),
        F.lit("ERP_SAP").alias("source_system"),
    )


def generate_recipes_bom(recipes, ingredients=fixed.INGREDIENTS, *, updated=VALID_FROM):
    """Recipe maps flattened to rows with the unit and cost of each ingredient."""
    spark = recipes.sparkSession
    priced = spark.createDataFrame(
        [(n, u, Decimal(str(c))) for n, u, c in ingredients],
        "ingredient_name string, unit_of_measure string, ingredient_cost_per_unit decimal(10,6)",
    )
    rows = recipes.select("product_name", F.explode("amounts").alias("ingredient_name", "qty_required_per_unit"))
    return lookup_join(rows, priced, ["ingredient_name"], "inner").select(
        "product_name",
        "ingredient_name",
        "qty_required_per_unit",
        "unit_of_measure",
        "ingredient_cost_per_unit",
        F.lit(updated).alias("last_updated"),
    )


def _days(first, last):
    return F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))


def _spread(entities):
    """Entities dealt evenly over tasks: a few in one small file expand to many rows each."""
    return entities.repartition(int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def generate_daily_inventory(stores, ingredients=fixed.INGREDIENTS, *, seed=SEED, first_day=FIRST_DAY, last_day=LAST_DAY):
    """Stock of each ingredient and store, day by day.

    Mondays restock a series below 350 units, so receipts depend on the stock
    and each series is folded in day order. A series is one array of calendar
    days; series spread over the cluster.
    """
    names = F.array(*[F.lit(i[0]) for i in ingredients])
    series = _spread(stores.select("store_id", "store_name", F.explode(names).alias("ingredient_name")))
    key = ("store_id", "ingredient_name")

    def drawn(low, high, scale, label):
        return lambda day: uniform(low, high, scale, seed, label, *key, day)

    base, waste, receipt = drawn("40", "120", 4, "base"), drawn("1.05", "1.15", 4, "waste"), drawn("600", "900", 1, "receipt")

    def movement(day):
        weekend = F.when(F.weekday(day) >= 5, F.lit(Decimal("1.35"))).otherwise(F.lit(Decimal("1.00")))
        return F.struct(
            day.alias("day"),
            (base(day) * weekend * waste(day)).cast("decimal(12,1)").alias("consumed"),
            F.when(F.weekday(day) == 0, receipt(day)).otherwise(F.lit(0)).cast("decimal(12,1)").alias("restock"),
        )

    zero = F.lit(Decimal("0.0")).cast("decimal(12,1)")
    first_stock = uniform("600", "1400", 1, seed, "stock", *key).cast("decimal(12,1)")
    row_type = (
        "array<struct<day:date,opening:decimal(12,1),received:decimal(12,1),consumed:decimal(12,1),closing:decimal(12,1)>>"
    )
    start = F.struct(first_stock.alias("stock"), F.array().cast(row_type).alias("rows"))

    def step(state, move):
        received = F.when(state["stock"] < 350, move["restock"]).otherwise(zero)
        closing = F.greatest(zero, (state["stock"] + received - move["consumed"]).cast("decimal(12,1)"))
        row = F.struct(
            move["day"].alias("day"),
            state["stock"].alias("opening"),
            received.alias("received"),
            move["consumed"].alias("consumed"),
            closing.alias("closing"),
        )
        return F.struct(closing.alias("stock"), F.array_append(state["rows"], row).alias("rows"))

    folded = F.aggregate(F.transform(_days(first_day, last_day), movement), start, step, lambda s: s["rows"])
    rows = series.select(*key, "store_name", F.explode(folded).alias("r"))
    return rows.select(
        F.col("r.day").alias("inventory_date"),
        "store_id",
        "store_name",
        "ingredient_name",
        F.col("r.opening").alias("opening_stock"),
        F.col("r.received").alias("units_received"),
        F.col("r.consumed").alias("actual_consumed"),
        F.col("r.closing").alias("closing_stock"),
    )


def generate_staff_shifts(stores, shifts=fixed.SHIFTS, *, seed=SEED, first_day=FIRST_DAY, last_day=LAST_DAY):
    """The day's shifts per store, some with one more employee at the weekend."""
    plan = F.array(
        *[
            F.struct(
                F.lit(name).alias("shift_type"),
                F.lit(start).alias("shift_start"),
                F.lit(end).alias("shift_end"),
                F.lit(employees).alias("employees"),
                F.lit(hours).alias("hours"),
                F.lit(Decimal(str(rate))).cast("decimal(6,2)").alias("rate"),
                F.lit(extra).alias("extra"),
            )
            for name, hours, start, end, employees, rate, extra in shifts
        ]
    )
    rows = (
        _spread(stores).select("store_id", "store_name", F.explode(_days(first_day, last_day)).alias("shift_date"))
        .withColumn("s", F.explode(plan))
        .select("*", "s.*")
    )
    weekend = F.weekday("shift_date") >= 5
    staffed = rows.withColumn("employees_on_shift", F.col("employees") + F.when(weekend & F.col("extra"), 1).otherwise(0))
    factor = uniform("0.98", "1.05", 4, seed, "labor", "store_id", "shift_date", "shift_type")
    hours = F.col("employees_on_shift") * F.col("hours")
    return staffed.select(
        "shift_date",
        "store_id",
        "store_name",
        "shift_type",
        "shift_start",
        "shift_end",
        "employees_on_shift",
        F.col("hours").cast("decimal(4,1)").alias("hours_per_employee"),
        hours.cast("decimal(6,1)").alias("total_hours"),
        F.col("rate").alias("hourly_rate_usd"),
        (hours * F.col("rate") * factor).cast("decimal(10,2)").alias("labor_cost_usd"),
    )


def generate_promotions(spark, promotions=fixed.PROMOTIONS):
    kinds = {c: "double" if c == "discount_value" else "string" for c in PROMOTIONS}
    return spark.createDataFrame(promotions, ", ".join(f"{c} {t}" for c, t in kinds.items()))


def generate_all(spark, bronze_root, run_date, *, seed=SEED):
    """Generate and land all five datasets; returns rows written per dataset, counted while writing."""
    stores = store_table(spark)
    datasets = {
        "bronze_product_costs": generate_product_costs(product_catalog(spark), seed=seed),
        "bronze_recipes_bom": generate_recipes_bom(recipe_table(spark)),
        "bronze_daily_inventory": generate_daily_inventory(stores, seed=seed),
        "bronze_staff_shifts": generate_staff_shifts(stores, seed=seed),
        "bronze_promotions": generate_promotions(spark),
    }
    written = {}
    for name, df in datasets.items():
        seen = Observation(name)
        write_bronze(df.observe(seen, F.count(F.lit(1)).alias("rows")), bronze_root, name, run_date)
        written[name] = seen.get["rows"]
    return written
