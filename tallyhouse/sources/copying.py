"""Copies of arrivals that skip what is equal and prove themselves complete.

A file is compared by the multiset of its lines (count, sum and xor of hashes), so nothing is parsed and the fingerprints
of files add up to that of an arrival. Files travel as lines on the executors, one target file each: quoting, headers and
odd bytes stay as they are; only a last line without a line feed gains one.
"""

import codecs
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.fingerprints import PARTS, fingerprint, merged
from tallyhouse.schemas import ARRIVAL
from tallyhouse.sources.files import delete, exists

FILES = f"{ARRIVAL} string, file string, bytes bigint, n_rows bigint, hash_sum decimal(38,0), hash_xor bigint"


class CopyFailed(RuntimeError):
    """Some files did not arrive whole; `report` has a row for each file."""

    def __init__(self, failed, report):
        super().__init__(f"{failed} file(s) did not arrive whole")
        self.report = report


def _folders(spark, path, dates):
    return [f"{path}/{ARRIVAL}={date}" for date in dates if exists(spark, f"{path}/{ARRIVAL}={date}")]


def _place(arrival, file):
    return F.regexp_extract("path", f"{ARRIVAL}=([^/]*)/[^/]*$", 1).alias(arrival), F.regexp_extract("path", "[^/]*$", 0).alias(file)


def _listed(spark, folders):
    return spark.read.format("binaryFile").load(folders).select(*_place(ARRIVAL, "file"), F.col("length").alias("bytes"))


def _lines(spark, folders):
    """Lines of the files as they lie: value, path, and the place in the file as (_from, _line)."""
    return spark.read.option("lineSep", "\n").text(folders).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_from"),
        F.monotonically_increasing_id().alias("_line"),
    )


def file_fingerprints(spark, path, dates):
    """One row per file of these arrivals: arrival, file name, bytes and the fingerprint of its lines.

    Files without a byte hold nothing to copy and have no row.
    """
    folders = _folders(spark, path, dates)
    if not folders:
        return spark.createDataFrame([], FILES)
    prints = _lines(spark, folders).groupBy("path").agg(*fingerprint(["value"])).select(*_place("_arrival", "_file"), *PARTS)
    same = (F.col(ARRIVAL) == F.col("_arrival")) & (F.col("file") == F.col("_file"))
    return _listed(spark, folders).join(prints, same).select(ARRIVAL, "file", "bytes", *PARTS)


def _with_mark(batches):
    """The lines of one file, with the byte order mark before the first that the reader of lines leaves out."""
    marked = False
    for batch in batches:
        if batch.num_rows and not marked:
            lines = batch["value"].to_pylist()
            batch, marked = pa.record_batch([pa.array([codecs.BOM_UTF8 + lines[0], *lines[1:]], pa.binary())], ["value"]), True
        yield batch


def _copy_files(spark, source, target, dates):
    """Write every file of the arrivals to the target, replacing just these arrivals.

    Files are read in pieces, several tasks to a large one, and each is written by one task, line by line as they lay:
    no task holds a file in memory.
    """
    folders = _folders(spark, source, dates)
    lines = _lines(spark, folders)
    # A file that is longer than its lines begins with a byte order mark.
    sizes = lines.groupBy("path").agg(F.sum(F.octet_length("value") + F.lit(1)).alias("_written"))
    sizes = sizes.select("path", "_written", *_place("_arrival", "_file"))
    same = (F.col("_arrival") == F.col(ARRIVAL)) & (F.col("_file") == F.col("file"))
    files = sizes.join(_listed(spark, folders), same, "left").select("path", "_arrival", F.expr("bytes > _written + 1").alias("_mark"))
    plain, marked = [], {}
    for path, date, mark in files.collect():
        own = marked.setdefault(date, []) if mark else plain
        own.append((path, date, len(own)))
    for date in dates:
        if exists(spark, f"{target}/{ARRIVAL}={date}"):
            delete(spark, f"{target}/{ARRIVAL}={date}")

    def in_order(own):
        # The date must not be nullable: the writer would sort the lines anew.
        numbers = spark.createDataFrame(own, f"path string not null, {ARRIVAL} string not null, _at int not null")
        dealt = lines.join(F.broadcast(numbers), "path").repartitionById(len(own), F.col("_at"))
        return dealt.sortWithinPartitions(ARRIVAL, "_from", "_line")

    if plain:
        rows = in_order(plain).select("value", ARRIVAL)
        rows.write.mode("append").option("lineSep", "\n").partitionBy(ARRIVAL).text(str(target))
    for date, own in marked.items():
        rows = in_order(own).select(F.col("value").cast("binary").alias("value")).mapInArrow(_with_mark, "value binary")
        rows.select(F.col("value").cast("string").alias("value")).write.mode("append").option("lineSep", "\n").text(
            f"{target}/{ARRIVAL}={date}"
        )


def copy_arrivals(spark, source, target, dates, *, dataset=None):
    """Copy arrivals of one dataset between two folders; returns a row per source file.

    Columns: dataset, ingestion_date, file, bytes, n_rows (lines), status. `same`: the target held the arrival already and
    it was left alone. `copied`: a file with the same lines is in the target now. `failed`: none is.
    """
    dates = [str(date) for date in dates]
    ours = file_fingerprints(spark, source, dates).persist()
    theirs = file_fingerprints(spark, target, dates)
    try:
        known = [f.groupBy(ARRIVAL).agg(*merged()).withColumn("side", F.lit(side)) for side, f in (("a", ours), ("b", theirs))]
        by_date = {}
        for row in reduce(DataFrame.union, known).collect():
            by_date.setdefault(row[ARRIVAL], {})[row["side"]] = tuple(row[c] for c in PARTS)
        stale = [date for date in dates if (s := by_date.get(date, {})).get("a") is not None and s.get("a") != s.get("b")]
        if stale:
            _copy_files(spark, source, target, stale)
        arrived = file_fingerprints(spark, target, stale).select(ARRIVAL, *PARTS).distinct().withColumn("_there", F.lit(True))
        status = (
            F.when(~F.col(ARRIVAL).isin(*stale), "same").when(F.col("_there"), "copied").otherwise("failed")
            if stale else F.lit("same")
        )
        report = ours.join(arrived, [ARRIVAL, *PARTS], "left").select(
            F.lit(dataset).alias("dataset"), ARRIVAL, "file", "bytes", "n_rows", status.alias("status")
        )
        # One short row per file: the report is fixed before a later copy changes what it says.
        return spark.createDataFrame(report.collect(), report.schema)
    finally:
        ours.unpersist()


def checked(reports):
    """The reports of several datasets as one; raises `CopyFailed` if any file failed."""
    report = reduce(DataFrame.union, reports)
    failed = report.where("status = 'failed'").count()
    if failed:
        raise CopyFailed(failed, report)
    return report
