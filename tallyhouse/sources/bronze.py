"""Bronze: text snapshots, one folder per arrival date.

Columns bind by header name, never by position, and a rerun of an arrival date
replaces exactly its own folder.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyhouse.schemas import ARRIVAL, BRONZE, text_schema
from tallyhouse.sources import copying
from tallyhouse.sources.files import exists, hadoop_path, list_names

DATASETS = tuple(BRONZE)


def dataset_path(root, dataset):
    return f"{root}/{BRONZE[dataset][0]}"


def write_bronze(df, root, dataset, run_date, *, source_file=None, now=None, files=None):
    """Write one arrival snapshot as CSV with a header.

    `source_file` adds the lineage columns. The number of files follows the
    input partitions unless `files` is given; nothing is gathered into one task.
    """
    if source_file is not None:
        stamp = F.lit(now) if now is not None else F.current_timestamp()
        df = df.withColumns({"ingestion_timestamp": stamp.cast("string"), "source_file": F.lit(source_file)})
    if files is not None:
        df = df.coalesce(files)
    _replace_arrival(df, dataset_path(root, dataset), run_date)


def _replace_arrival(df, path, date):
    """Write rows as the whole snapshot of a date: without rows the snapshot is empty afterwards, not the old one."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/{ARRIVAL}={date}")


def _arrival_dates(spark, path):
    """Arrival dates below a path from its folder names, oldest first; no file is opened."""
    prefix = f"{ARRIVAL}="
    return [n.removeprefix(prefix) for n in list_names(spark, path) if n.startswith(prefix)]


def latest_arrival(spark, path):
    """The greatest arrival date below a path, None without any."""
    return max(_arrival_dates(spark, path), default=None)


def _snapshots(spark, path, dates):
    """Tables of the snapshots of these dates, those of one header read together.

    Every folder binds by its own header. A file whose header differs from the others in its folder fails.
    """
    by_header = {}
    for date in dates:
        header = spark.read.option("header", True).option("escape", '"').csv(f"{path}/{ARRIVAL}={date}").columns
        if header:
            by_header.setdefault(tuple(header), []).append(date)
    def reader(columns):
        schema = StructType([StructField(c, StringType()) for c in columns])
        return spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False)

    for header, own in by_header.items():
        folders = [f"{path}/{ARRIVAL}={date}" for date in own]
        if ARRIVAL in header:
            # The folder's date counts, not a column of the same name.
            for date, folder in zip(own, folders):
                yield reader(header).csv(folder).withColumn(ARRIVAL, F.lit(date))
        else:
            yield reader([*header, ARRIVAL]).option("basePath", str(path)).csv(folders)


def read_bronze(spark, root, dataset, *, latest=False):
    """A Bronze dataset as text, bound by the header of each arrival; declared columns an arrival lacks are NULL.

    `latest` takes the newest arrival from the folder names, so the scan lists and reads that folder only. Staging such
    a table needs no further snapshot filter.
    """
    path = dataset_path(root, dataset)
    dates = _arrival_dates(spark, path)
    if not dates:
        raise FileNotFoundError(f"no arrivals below {path}")
    newest = max(dates)
    wanted = [*BRONZE[dataset][1], ARRIVAL]
    parts = [
        found.select(*[(F.col(c) if c in found.columns else F.lit(None)).cast("string").alias(c) for c in wanted])
        for found in _snapshots(spark, path, [newest] if latest else dates)
    ]
    if not parts:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in wanted]))
    rows = reduce(DataFrame.union, parts)
    return rows.where(F.col(ARRIVAL) == F.lit(newest)) if latest else rows


def read_all_bronze(spark, root, *, latest=False):
    return {name: read_bronze(spark, root, name, latest=latest) for name in DATASETS}


def arrivals(spark, root, dataset):
    """Arrival folders of a dataset, oldest first."""
    return _arrival_dates(spark, dataset_path(root, dataset))


def copy_report(spark, source_root, target_root, *, run_date=None, full_refresh=False, datasets=DATASETS):
    """Copy one arrival date, or all of them, of every dataset to another Bronze root; returns a row per file.

    Each date replaces its folder in the target, unless the target holds the same lines already; see
    `copying.copy_arrivals`. Nothing to copy is an error, and so is a file that did not arrive whole.
    """
    if run_date is None and not full_refresh:
        raise ValueError("name a run_date or ask for a full refresh")
    reports = []
    for dataset in datasets:
        present = arrivals(spark, source_root, dataset)
        wanted = present if full_refresh else [d for d in present if d == run_date]
        if wanted:
            source, target = dataset_path(source_root, dataset), dataset_path(target_root, dataset)
            reports.append(copying.copy_arrivals(spark, source, target, wanted, dataset=dataset))
    if not reports:
        raise FileNotFoundError(f"no Bronze files for {run_date or 'any date'} in {source_root}")
    return copying.checked(reports)


def copy_bronze(spark, source_root, target_root, *, run_date=None, full_refresh=False):
    """Copy as `copy_report` does; returns the (dataset, date) pairs that the target now holds."""
    report = copy_report(spark, source_root, target_root, run_date=run_date, full_refresh=full_refresh)
    pairs = {tuple(row) for row in report.select("dataset", ARRIVAL).distinct().collect()}
    return sorted(pairs, key=lambda pair: (DATASETS.index(pair[0]), pair[1]))


def arrival_status(tables):
    """One row per dataset: whether it holds any row. Reads at most one row of each."""
    checks = [
        df.limit(1).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("dataset"), (F.col("n") > 0).alias("arrived")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def verify_arrivals(spark, root, *, datasets=DATASETS):
    """One row per expected dataset: whether its folder holds data. A missing folder counts as not arrived."""
    rows = []
    for dataset in datasets:
        path = dataset_path(root, dataset)
        found = exists(spark, path) and not spark.read.format("binaryFile").option(
            "recursiveFileLookup", True
        ).load(path).select("path").isEmpty()
        rows.append((dataset, found))
    return spark.createDataFrame(rows, "dataset string, arrived boolean")


def row_counts(tables):
    """Row count of each table, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def declared_columns():
    """Declared Bronze columns as rows `(table, position, column, type, is partition)`."""
    rows = []
    for name, (_, columns, partitioned) in BRONZE.items():
        rows += [(name, i, c, "string", False) for i, c in enumerate(columns)]
        if partitioned:
            rows.append((name, len(columns), ARRIVAL, "string", True))
    return rows


def create_bronze_tables(spark, root, database):
    """Declare the datasets as external CSV tables of a catalog database.

    The column list follows the header of the newest files where there are any.
    A table has one column order: reading arrivals of another header through it
    fails instead of swapping columns; `read_bronze` reads those too.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (_, columns, partitioned) in BRONZE.items():
        path = dataset_path(root, name)
        if list_names(spark, path):
            newest = latest_arrival(spark, path)
            folder = f"{path}/{ARRIVAL}={newest}" if newest else path
            columns = [c for c in spark.read.option("header", True).csv(folder).columns if c != ARRIVAL]
        else:
            fs, folder = hadoop_path(spark, path)
            fs.mkdirs(folder)
        fields = text_schema(columns).fields
        # Generated sets are stored below their arrival date even where the table is not snapshot-filtered.
        if partitioned or arrivals(spark, root, name):
            partitioned = True
            fields = [*fields, StructField(ARRIVAL, StringType())]
        ddl = ", ".join(f"`{f.name}` STRING" for f in StructType(fields).fields)
        by = f"PARTITIONED BY ({ARRIVAL})" if partitioned else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}) USING csv "
            f"OPTIONS (header 'true', escape '\"', enforceSchema 'false') {by} LOCATION '{path}'"
        )


def repair_partitions(spark, database, tables=DATASETS):
    """Register the arrival folders that appeared since the tables were declared."""
    repaired = []
    for name in tables:
        table = f"{database}.{name}"
        if any(c.isPartition for c in spark.catalog.listColumns(table)):
            spark.sql(f"MSCK REPAIR TABLE {table}")
            repaired.append(name)
    return repaired
