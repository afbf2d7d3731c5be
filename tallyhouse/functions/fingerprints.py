"""Fingerprints of multisets of rows: independent of order and partitions, and mergeable by adding up."""

from pyspark.sql import functions as F

PARTS = ("n_rows", "hash_sum", "hash_xor")


def row_hash(columns, seed):
    """64-bit hash of a row's columns. NULL flags take part: the hash function itself skips NULLs."""
    flags = F.concat(*[F.isnull(c).cast("int").cast("string") for c in columns]) if columns else F.lit("")
    return F.xxhash64(F.lit(seed), flags, *[F.col(c) if isinstance(c, str) else c for c in columns])


def fingerprint(columns):
    """Aggregates of the columns' multiset: its size, the exact sum of one hash and the xor of another.

    The sum tells copies of a row apart that the xor cancels. Fingerprints of disjoint parts merge: see `merged`.
    """
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(row_hash(columns, 1).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.bit_xor(row_hash(columns, 2)), F.lit(0).cast("bigint")).alias("hash_xor"),
    ]


def merged():
    """Aggregates that put fingerprints of disjoint parts together."""
    return [
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum("hash_sum"), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.bit_xor("hash_xor"), F.lit(0).cast("bigint")).alias("hash_xor"),
    ]


def table_fingerprint(df):
    """One row: the fingerprint of a table over all its columns, by name."""
    return df.agg(*fingerprint([f"`{c}`" for c in sorted(df.columns)]))


def fingerprints_by(df, keys, columns=None):
    """A fingerprint for each value of the keys, over all other columns or the ones given."""
    columns = columns or sorted(c for c in df.columns if c not in keys)
    return df.groupBy(*keys).agg(*fingerprint([f"`{c}`" for c in columns]))


def changed_members(new, old, keys):
    """Keys whose fingerprint is in one table only or differs between both."""
    same = [F.col(f"_n.{c}").eqNullSafe(F.col(f"_o.{c}")) for c in PARTS]
    on = None
    for key in keys:
        match = F.col(f"_n.{key}").eqNullSafe(F.col(f"_o.{key}"))
        on = match if on is None else on & match
    both = new.alias("_n").join(old.alias("_o"), on, "full_outer")
    equal = same[0] & same[1] & same[2]
    return both.where(~equal).select(*[F.coalesce(f"_n.{k}", f"_o.{k}").alias(k) for k in keys])
