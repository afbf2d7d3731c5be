"""Raw POS files: choose, load as text, validate."""

from pyspark.sql import functions as F

from tallyhouse.functions.text import header_name
from tallyhouse.schemas import POS
from tallyhouse.sources.files import list_names

# Fixed value: the raw file taken when several are present.
PREFERRED_FILE = "coffee_shop_sales.csv"
REQUIRED_COLUMNS = tuple(POS)


class LandingRejected(ValueError):
    """The raw file does not meet the landing rules."""


def choose_raw_file(spark, folder, preferred=PREFERRED_FILE):
    """The preferred file, else the only CSV of the folder."""
    names = list_names(spark, folder, ".csv")
    if preferred in names:
        return f"{folder}/{preferred}"
    if not names:
        raise FileNotFoundError(f"no CSV file in {folder}")
    if len(names) > 1:
        raise FileExistsError(f"several CSV files in {folder} and none is {preferred}: {names}")
    return f"{folder}/{names[0]}"


def load_raw_pos(spark, path, *, null_markers=()):
    """Raw CSV as text columns with normalised names; blank fields are NULL.

    `null_markers` lists further texts that mean NULL, such as 'NA'.
    """
    raw = (
        spark.read.option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("escape", '"')
        .csv(str(path))
    )
    raw = raw.toDF(*[header_name(c) for c in raw.columns])
    if null_markers:
        raw = raw.select(*[F.when(~F.col(c).isin(*null_markers), F.col(c)).alias(c) for c in raw.columns])
    return raw


def landing_report(df, *, required=REQUIRED_COLUMNS, min_rows=100, key="transaction_id"):
    """One row: number of rows and columns, missing columns, NULL keys, and whether the file is valid."""
    missing = sorted(set(required) - set(df.columns))
    nulls = F.count_if(F.col(key).isNull()) if key in df.columns else F.lit(0).cast("bigint")
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.alias("null_keys"))
    valid = F.lit(not missing) & (F.col("n_rows") >= min_rows) & (F.col("null_keys") == 0)
    return totals.select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_cols"),
        F.lit(",".join(missing)).alias("missing_columns"),
        "null_keys",
        valid.alias("valid"),
    )


def validate_landing(df, **rules):
    """The report as a dict with the issues spelled out; one scan, one row to the driver."""
    found = landing_report(df, **rules).first()
    issues = []
    if found.missing_columns:
        issues.append(f"missing columns: {found.missing_columns.split(',')}")
    if found.n_rows < rules.get("min_rows", 100):
        issues.append(f"too few rows: {found.n_rows}")
    if found.null_keys:
        issues.append(f"rows without {rules.get('key', 'transaction_id')}: {found.null_keys}")
    return {"valid": found.valid, "issues": issues, "rows": found.n_rows, "cols": df.columns}


def land_pos(spark, raw_folder, bronze_root, run_date, *, preferred=PREFERRED_FILE, now=None):
    """Choose, load, validate and write one raw POS file as a Bronze snapshot; returns the report."""
    from tallyhouse.sources.bronze import write_bronze

    path = choose_raw_file(spark, raw_folder, preferred)
    raw = load_raw_pos(spark, path)
    report = validate_landing(raw)
    if not report["valid"]:
        raise LandingRejected(f"{path}: {report['issues']}")
    write_bronze(raw, bronze_root, "bronze_pos_transactions", run_date, source_file=path.rsplit("/", 1)[-1], now=now)
    return report
