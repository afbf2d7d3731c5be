"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local threads. Each query is
planned and run in full BENCH_RUNS times (2 by default) and its best time counts,
so that class loading and JIT compilation do not hide the plan's own cost.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyhouse.session import build_session
from workload.bound import Bound
from workload.catalog import QUERIES

HEADLINE = (
    "stg_07_pos_transactions",
    "jn_02_validity_join",
    "int_02_theoretical_consumption",
    "win_03_roll_forward",
    "win_05_rank",
    "dim_03_product",
    "fct_01_sales",
    "fct_02_waste",
    "fct_03_labor",
    "fct_04_inventory_snapshot",
    "dq_05_cost_coverage",
    "dg_03_mapping_backlog",
    "rpt_01_top_margin_products",
    "rpt_02_labor_efficiency_trend",
    "rpt_03_weekly_waste_by_store",
    "kpi_01_sales_totals",
    "kpi_09_revenue_by_category",
    "kpi_10_product_table",
)


def run(build, spark, sf_dir):
    """Plan and execute a query in full; the sink drops the rows."""
    started = time.perf_counter()
    build(Bound(spark, sf_dir)).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", master=f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false", spark_driver_memory="12g"
    )
    spark.sparkContext.setLogLevel("OFF")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    queries = {name: min(run(QUERIES[name][0], spark, sf_dir) for _ in range(runs)) for name in names}
    total = round(sum(queries.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": queries, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
