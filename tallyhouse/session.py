"""Session settings the library is tuned for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sizes up to which a join side is broadcast: as its files tell before the run, and as its shuffle output measures.
    "spark.sql.autoBroadcastJoinThreshold": str(16 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name="tallyhouse", master=None, **settings):
    """A session with the library's defaults; keyword settings win (use `spark_sql_x` for `spark.sql.x`)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), str(value))
    return builder.getOrCreate()
