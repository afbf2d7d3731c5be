"""Records of runs: gate results, run summaries, the backlog file."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tallyhouse.plans.diagnostics import order_backlog
from tallyhouse.sources.files import exists


def gate_store(root):
    """A store for `run_gates`: JSON by run date and gate, results and the violations of failing gates."""

    def save(results, failures):
        rows = results.collect()
        for row in rows:
            # A gate replaces its own earlier result and violations only: several runs of a day add up.
            where = f"run_date={row.run_date}/gate={row.gate}"
            own = results.where(F.col("gate") == row.gate).drop("run_date", "gate")
            own.write.mode("overwrite").json(f"{root}/results/{where}")
            if row.gate in failures:
                failures[row.gate].write.mode("overwrite").json(f"{root}/failures/{where}")
            elif exists(results.sparkSession, f"{root}/failures/{where}"):
                results.limit(0).select("level").write.mode("overwrite").json(f"{root}/failures/{where}")

    return save


def run_summary(spark, *, run_date, run_id, status, failed_tasks=(), completed=None):
    """One row describing a finished run; failures name the first task and all of them."""
    completed = completed or datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    failed = list(failed_tasks)
    row = (
        run_date,
        status,
        completed,
        run_id,
        failed[0] if failed else None,
        failed or None,
        "Review the logs of the failed tasks" if failed else None,
    )
    schema = (
        "run_date string, status string, completed string, dag_run_id string, "
        "failed_task string, failed_tasks array<string>, action string"
    )
    return spark.createDataFrame([row], schema)


def write_run_summary(summary, root):
    """Store the summary of a run date, replacing an earlier one of the same date."""
    (
        summary.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .json(f"{root}/pipeline-runs")
    )


def write_backlog(backlog, path):
    """The mapping backlog as CSV with a header, in review order."""
    order_backlog(backlog).write.mode("overwrite").option("header", True).option("escape", '"').csv(str(path))
