"""The library's tables built lazily over one scale-factor folder."""

from functools import cached_property

import uuid

from pyspark.sql import functions as F

from tallyhouse.operators import ordered, staging
from tallyhouse.plans import cube, dimensions, facts, intermediate, rebuild
from tallyhouse.sources import gold
from workload.scratch import scratch_folder
from workload.views import VIEWS, references

OPENING_STOCK = 900


class Bound:
    """Bronze, Silver and Gold frames of one folder; each is planned once and on first use."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir
        self.tables = {}

    def table(self, name):
        if name not in self.tables:
            self.tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.tables[name]

    def view(self, name):
        inputs = {n: getattr(self, n) if n in VIEWS else self.table(n) for n in set(references(VIEWS[name]))}
        return self.spark.sql(VIEWS[name], **inputs)

    def stored(self, df, name, partition_by=()):
        """The table written to a new folder of the cluster's scratch space and read back."""
        root = f"{scratch_folder(self.spark)}/{uuid.uuid4().hex}"
        gold.write_table(df, root, name, partition_by=partition_by)
        return gold.read_table(self.spark, root, name)

    b_pos = cached_property(lambda self: self.view("b_pos"))
    b_costs = cached_property(lambda self: self.view("b_costs"))
    b_cost_versions = cached_property(lambda self: self.view("b_cost_versions"))
    b_bom = cached_property(lambda self: self.view("b_bom"))
    b_movements = cached_property(lambda self: self.view("b_movements"))
    b_shifts = cached_property(lambda self: self.view("b_shifts"))
    b_mapping = cached_property(lambda self: self.view("b_mapping"))
    b_promotions = cached_property(lambda self: self.view("b_promotions"))

    @cached_property
    def b_inventory(self):
        """Counts with openings and closings rolled forward from the movements."""
        rolled = ordered.roll_forward(
            self.b_movements, ["store_id", "ingredient_name"], "inventory_date", OPENING_STOCK,
            "units_received", "actual_consumed",
        )
        store = F.concat(F.lit("Loc "), F.col("store_id").cast("string"))
        return rolled.withColumns({"store_name": store, "ingestion_date": F.lit("2023-06-15")})

    @cached_property
    def b_counts(self):
        """Counts whose milk openings do not continue the day before."""
        gap = F.when(F.col("ingredient_name") == "milk_ml", F.lit(7)).otherwise(F.lit(0))
        return self.b_inventory.withColumn("opening_stock", F.col("opening_stock") + gap)

    @property
    def bronze(self):
        return {
            "bronze_pos_transactions": self.b_pos,
            "bronze_product_costs": self.b_costs,
            "bronze_recipes_bom": self.b_bom,
            "bronze_daily_inventory": self.b_counts,
            "bronze_staff_shifts": self.b_shifts,
            "bronze_promotions": self.b_promotions,
            "product_name_mapping": self.b_mapping,
            "stg_pos_transactions": self.lines,
        }

    lines = cached_property(lambda self: staging.stage_pos_lines(self.b_pos, self.b_mapping))
    # Numbering looks for large transactions first, so it reads the lines twice: store them once.
    # So is the mapping before: its true size decides how it is joined.
    silver_lines = cached_property(
        lambda self: self.stored(
            staging.stage_pos_lines(self.b_pos, self.stored(self.b_mapping, "mapping")), "stg_pos_lines"
        )
    )
    stg_pos = cached_property(lambda self: staging.number_pos(self.silver_lines))
    stg_costs = cached_property(lambda self: staging.stage_costs(self.b_costs))
    stg_bom = cached_property(lambda self: staging.stage_bom(self.b_bom))
    stg_inventory = cached_property(lambda self: staging.stage_inventory(self.b_inventory))
    stg_shifts = cached_property(lambda self: staging.stage_shifts(self.b_shifts))

    int_sales = cached_property(lambda self: intermediate.sales_with_costs(self.stg_pos, self.stg_costs))
    theoretical = cached_property(lambda self: intermediate.theoretical_consumption(self.lines, self.stg_bom))
    labor = cached_property(lambda self: intermediate.labor_by_day(self.stg_shifts, self.lines))

    dim_date = cached_property(lambda self: dimensions.build_dim_date(self.spark))
    # Dimensions drawn from the lines are stored before facts join them, as in the daily build:
    # they are computed once, and their true size decides how they are joined.
    dim_store = cached_property(lambda self: self.stored(dimensions.build_dim_store(self.lines), "dim_store"))
    dim_product = cached_property(
        lambda self: self.stored(dimensions.build_dim_product(self.lines, self.stg_costs), "dim_product")
    )
    dim_ingredient = cached_property(lambda self: dimensions.build_dim_ingredient(self.stg_bom))

    def sales_fact(self, lines):
        """The sales fact; stores and products read the stored lines too."""
        self.dim_store, self.dim_product = (
            self.stored(dimensions.build_dim_store(self.silver_lines), "dim_store"),
            self.stored(dimensions.build_dim_product(self.silver_lines, self.stg_costs), "dim_product"),
        )
        sales = intermediate.sales_with_costs(lines, self.stg_costs)
        return facts.build_fct_sales(sales, self.dim_date, self.dim_store, self.dim_product)

    fct_sales = cached_property(lambda self: self.sales_fact(self.stg_pos))
    # Without line numbers, for reports that do not show them.
    sales_measures = cached_property(lambda self: self.sales_fact(self.silver_lines))

    @cached_property
    def fct_waste(self):
        return facts.build_fct_waste(
            self.theoretical, self.stg_inventory, self.dim_date, self.dim_store, self.dim_ingredient
        )

    @cached_property
    def fct_labor(self):
        return facts.build_fct_labor(self.labor, self.dim_date, self.dim_store)

    @cached_property
    def fct_inventory_snapshot(self):
        return facts.build_fct_inventory_snapshot(self.stg_inventory, self.dim_date, self.dim_store)

    # One stored table each for all sliced queries, cut into folders by what a slice picks.
    kpi_cube = cached_property(lambda self: self.stored(cube.build_cube(self.gold), "kpi_cube", ["fact", "level"]))
    order_cube = cached_property(lambda self: self.stored(cube.build_order_cube(self.gold), "order_cube", ["fact", "level"]))

    @cached_property
    def gold(self):
        """Gold tables for reports; none of them shows line numbers."""
        return LazyGold(self, {"fct_sales": "sales_measures"})

    @cached_property
    def full_gold(self):
        """All Gold tables from lines, costs and recipes that are worked out once."""
        self.lines = self.silver_lines
        self.b_costs, self.b_bom = self.stored(self.b_costs, "costs"), self.stored(self.b_bom, "bom")
        return LazyGold(self, {})

    def silver(self):
        return {
            "stg_pos_transactions": self.stored(self.stg_pos, "stg_pos_transactions"),
            "stg_product_costs": self.stg_costs,
            "stg_recipes_bom": self.stg_bom,
            "stg_daily_inventory": self.stored(self.stg_inventory, "stg_daily_inventory"),
            "stg_staff_shifts": self.stg_shifts,
        }

    @cached_property
    def silver_tables(self):
        return self.silver()

    def dims(self, lines):
        return {
            "dim_date": self.dim_date,
            "dim_store": dimensions.build_dim_store(lines),
            "dim_product": dimensions.build_dim_product(lines, self.stg_costs),
            "dim_ingredient": self.dim_ingredient,
        }

    def rebuilt(self, fact):
        """A fact built from an earlier state of the inputs, then brought up to date.

        Earlier, one day of lines was absent, one had other quantities and one stood under another date; one day of counts
        was absent, one had another consumption, and the shifts of a day cost more.
        """
        silver = self.silver_tables
        lines, counts, shifts = (silver[n] for n in ("stg_pos_transactions", "stg_daily_inventory", "stg_staff_shifts"))
        on = lambda column, day: F.col(column) == F.lit(day).cast("date")
        early = lines.where(~on("transaction_date", "2023-03-10")).withColumns({
            "transaction_qty": F.col("transaction_qty") + on("transaction_date", "2023-02-02").cast("int"),
            "transaction_date": F.when(on("transaction_date", "2023-04-04"), F.lit("2023-06-30").cast("date")).otherwise(
                F.col("transaction_date")
            ),
        })
        more = F.when(on("inventory_date", "2023-03-20"), F.lit(5)).otherwise(F.lit(0))
        before = silver | {
            "stg_pos_transactions": early,
            "stg_daily_inventory": counts.where(~on("inventory_date", "2023-05-01")).withColumn(
                "actual_consumed", (F.col("actual_consumed") + more).cast("decimal(12,2)")
            ),
            "stg_staff_shifts": shifts.withColumn(
                "labor_cost_usd", F.when(on("shift_date", "2023-01-09"), F.col("labor_cost_usd") * 2).otherwise(
                    F.col("labor_cost_usd")
                ).cast("decimal(10,2)")
            ),
        }
        root = f"{scratch_folder(self.spark)}/{uuid.uuid4().hex}"
        rebuild.rebuild(self.spark, before, self.dims(early), root, only=(fact,))
        rebuild.rebuild(self.spark, silver, self.dims(lines), root, only=(fact,))
        return rebuild.read_fact(self.spark, root, fact)


class LazyGold(dict):
    """Gold tables by name, planned when asked for."""

    def __init__(self, bound, renamed):
        super().__init__()
        self.bound, self.renamed = bound, renamed

    def __missing__(self, name):
        self[name] = getattr(self.bound, self.renamed.get(name, name))
        return self[name]
