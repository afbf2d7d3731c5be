"""Gold tables as Parquet, and the BI snapshot export."""

import json
from datetime import datetime

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyhouse.functions.fingerprints import PARTS, fingerprint
from tallyhouse.schemas import GOLD_TABLES
from tallyhouse.sources.files import exists, hadoop_path


def table_path(root, table, schema="gold"):
    return f"{root}/{schema}/{table}"


def write_table(df, root, table, schema="gold", partition_by=()):
    """Replace one table.

    Partitioned tables are rebalanced on the partition columns first: small
    partitions get one file instead of one per task, and the adaptive planner
    splits large ones over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(table_path(root, table, schema))


def read_table(spark, root, table, schema="gold"):
    return spark.read.parquet(table_path(root, table, schema))


def read_gold(spark, root, schema="gold", tables=GOLD_TABLES):
    return {table: read_table(spark, root, table, schema) for table in tables}


def find_complete_schema(spark, root, candidates, tables=GOLD_TABLES):
    """The first candidate schema below `root` that holds every table."""
    for schema in candidates:
        if all(exists(spark, f"{table_path(root, table, schema)}/_SUCCESS") for table in tables):
            return schema
    raise LookupError(f"no schema of {list(candidates)} holds all of {list(tables)}")


def find_complete_database(spark, candidates, tables=GOLD_TABLES):
    """The first candidate catalog database that holds every table."""
    for database in candidates:
        if spark.catalog.databaseExists(database):
            if set(tables) <= {t.name for t in spark.catalog.listTables(database)}:
                return database
    raise LookupError(f"no database of {list(candidates)} holds all of {list(tables)}")


class ExportIncomplete(RuntimeError):
    """A file set that was read back differs from the table it came from."""


def as_text(df):
    """All columns as text, as an export writes them."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def _text_parts(columns):
    """Fingerprint of rows of text; an empty text and NULL look alike in CSV, so they count as one."""
    return fingerprint([F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in columns])


def export_snapshot(gold, target, *, snapshot_id=None, tables=GOLD_TABLES):
    """Write each table as a folder of CSV files under `target/snapshot_id`, and a manifest with rows and fingerprints.

    Rows are counted and fingerprinted while they are written. The files are then read back: an export whose files hold
    other rows than the table fails, and leaves no manifest. Large tables keep their parallelism: a folder holds as many
    files as tasks.
    """
    spark = gold[tables[0]].sparkSession
    snapshot_id = snapshot_id or datetime.now().strftime("%Y-%m-%d_%H%M%S")
    folder = f"{target}/{snapshot_id}"
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    listed = []
    for table in tables:
        seen = Observation(table)
        path = f"{folder}/{table}.csv"
        rows = as_text(gold[table])
        rows.observe(seen, *_text_parts(rows.columns)).write.mode("overwrite").option("header", True).option(
            "escape", '"'
        ).option("nullValue", "").options(**spaces).csv(path)
        written = {part: seen.get[part] for part in PARTS}
        again = spark.read.schema(rows.schema).option("header", True).option("escape", '"').option("multiLine", True).options(
            **spaces
        ).csv(path)
        found = again.agg(*_text_parts(rows.columns)).first()
        if any(found[part] != written[part] for part in PARTS):
            raise ExportIncomplete(f"{table}: {found.asDict()} in {path}, {written} in the table")
        listed.append({
            "table": table, "rows": written["n_rows"], "hash_sum": str(written["hash_sum"]), "hash_xor": written["hash_xor"],
            "output_file": path,
        })
    manifest = {"snapshot_id": snapshot_id, "generated_at": datetime.now().isoformat(), "tables": listed}
    fs, path = hadoop_path(spark, f"{folder}/manifest.json")
    out = fs.create(path, True)
    out.write(bytearray(json.dumps(manifest, indent=2).encode()))
    out.close()
    return manifest
