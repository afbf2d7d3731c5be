"""Embedding whitening: covariance of the distinct vectors by blockwise QR, components by a bidiagonal qd solver.

1. Entries become whole numbers; each distinct vector is kept once, as packed bytes (one shuffle, merged on the map side).
2. Exact sums per dimension. Tasks centre their vectors and reduce them to a triangle R block by block; triangles merge
   in groups, so that no task or driver sees more than a few d x d triangles.
3. The one triangle that is left goes to `bidiagonal.principal`: singular values and right vectors of R are the roots of
   n times the covariance's eigenvalues and its eigenvectors, without ever forming products of centred columns.
4. The whitened covariance is measured over the distinct vectors, then every row is projected.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from tallyhouse.llm import base
from tallyhouse.llm.bidiagonal import principal

COMPONENTS = 16
# Steps per unit and offset of the whole numbers.
STEPS, OFFSET = 64, 1_000_000
# Entries beyond it have no whole number of 64 bits.
LARGEST = 1e17
# Rows of a block that is reduced at once, and triangles merged at once.
BLOCK_ROWS, MERGED = 4096, 16


@dataclass
class Whitening:
    """What `fit` found: `n` distinct vectors, exact `sums`, `projection` (dimensions x components), `explained` shares,
    `identity_error` of the whitened covariance."""

    n: int
    sums: list
    projection: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def whole_mean(self):
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self):
        """Sums less n times the whole mean, below n each."""
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x):
        return (x - self.whole_mean) - self.rest / self.n


def whole_numbers(entries):
    return np.floor(STEPS * entries).astype(np.int64) + OFFSET


def _matrix(column, d):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _packed(x):
    """Each row as bytes, of 32-bit numbers where all entries fit and of 64-bit numbers otherwise."""
    fits = (np.abs(x) < 1 << 31).all(axis=1)
    return [(row.astype("<i4") if small else row.astype("<i8")).tobytes() for row, small in zip(x, fits)]


def _unpacked(column, d):
    cells = [np.frombuffer(c, "<i4" if len(c) == 4 * d else "<i8") for c in column.to_pylist()]
    return np.array(cells, np.int64).reshape(-1, d)


def usable_rows(df, key="vec_id", vector="embedding"):
    """(rows, d): key and vector (array<double>) of the rows that take part, and the vectors' length, None without rows.

    Left out: null vectors, vectors with null, non-finite or enormous (beyond 1e17) entries, and vectors of another length
    than the most frequent one (the longest of several).
    """
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    good = ~F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    rows = rows.where(F.col("vector").isNotNull()).where(good)
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    first = sizes.where("d > 0").orderBy(F.desc("n"), F.desc("d")).first()
    if first is None:
        return rows.limit(0), None
    return rows.where(F.size("vector") == first["d"]), first["d"]


def distinct_vectors(rows, d):
    """Stored table of each distinct whole-number vector once, packed."""

    def pack(batches):
        for batch in batches:
            x = whole_numbers(_matrix(batch.column(0), d))
            yield pa.RecordBatch.from_arrays([pa.array(_packed(x), pa.binary())], ["x"])

    return base.stored(rows.select("vector").mapInArrow(pack, "x binary").distinct(), "vectors")


def exact_sums(vectors, d):
    """(n, sums) of the table of distinct vectors, as whole numbers of any size."""

    def add(batches):
        n, high, low = 0, [0] * d, [0] * d
        for batch in batches:
            x = _unpacked(batch.column(0), d)
            n += len(x)
            high = [a + int(b) for a, b in zip(high, (x >> 32).sum(axis=0))]
            low = [a + int(b) for a, b in zip(low, (x & 0xFFFFFFFF).sum(axis=0))]
        if n:
            totals = [str((h << 32) + w) for h, w in zip(high, low)]
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d), pa.array(totals)], ["dim", "n", "s"])

    parts = vectors.mapInArrow(add, "dim int, n long, s string")
    found = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = [0] * d
    for row in found:
        sums[row["dim"]] = int(row["s"])
    return (found[0]["n"] if found else 0), sums


def _triangle(blocks, d):
    """R of the stacked blocks."""
    r = np.empty((0, d))
    for block in blocks:
        for at in range(0, len(block), BLOCK_ROWS):
            r = np.linalg.qr(np.vstack([r, block[at : at + BLOCK_ROWS]]), "r")
    return r


def _triangle_row(part, r):
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])


def triangle(vectors, model, d):
    """R of all centred vectors: each task reduces its own, then triangles merge by groups until one is left."""

    def reduce_own(batches):
        r = _triangle((model.centred(_unpacked(batch.column(0), d)) for batch in batches), d)
        if len(r):
            yield _triangle_row(TaskContext.get().partitionId(), r)

    def merge(table):
        table = table.sort_by("part")
        r = _triangle((np.frombuffer(c, float).reshape(-1, d) for c in table.column("r").to_pylist()), d)
        return pa.Table.from_batches([_triangle_row(table.column("part")[0].as_py() // MERGED, r)])

    schema = "part long, r binary"
    parts = base.stored(vectors.mapInArrow(reduce_own, schema), "triangles")
    while parts.count() > 1:
        merged = parts.groupBy(F.expr(f"part div {MERGED}")).applyInArrow(merge, schema)
        parts = base.stored(merged, "triangles")
    return np.frombuffer(parts.first()["r"], float).reshape(-1, d)


def measured_error(vectors, model, d):
    """Largest absolute entry of the covariance of the whitened distinct vectors less the identity."""
    k = model.projection.shape[1]

    def products(batches):
        sums, total = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.centred(_unpacked(batch.column(0), d)) @ model.projection
            sums += w.sum(axis=0)
            total += w.T @ w
        cells = np.concatenate([sums, total.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int32()), pa.array(cells)], ["cell", "value"])

    found = vectors.mapInArrow(products, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    cells = np.zeros(k + k * k)
    for row in found.collect():
        cells[row["cell"]] = row["value"]
    mean, second = cells[:k] / model.n, cells[k:].reshape(k, k) / model.n
    return float(np.max(np.abs(second - np.outer(mean, mean) - np.eye(k)), initial=0.0))


def _fit_rows(rows, d, count):
    vectors = distinct_vectors(rows, d)
    n, sums = exact_sums(vectors, d)
    if not n:
        return None
    model = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)
    r = triangle(vectors, model, d)
    squares, directions = principal(r, count)
    model.projection = directions / np.sqrt(squares / n)
    model.explained = squares / np.square(r).sum() if len(squares) else squares
    model.identity_error = measured_error(vectors, model, d)
    return model


def fit(df, key="vec_id", vector="embedding", count=COMPONENTS):
    """The `Whitening` of the table's distinct vectors, or None if no vector can be used (see `usable_rows`).

    Repeated vectors count once. Components whose variance can't be told from zero (constant dimensions, fewer vectors than
    dimensions, a single vector) are left out. Keys are not read, so null and repeated keys are fine.
    """
    base.ship(df.sparkSession)
    rows, d = usable_rows(df, key, vector)
    return _fit_rows(rows, d, count) if d else None


def _projected(rows, model, d):
    def project(batches):
        for batch in batches:
            x = whole_numbers(_matrix(batch.column(1), d))
            w = model.centred(x) @ model.projection
            # n * x - S, whole; the sum of squares is exact where 64 bits hold it, which the rough one tells.
            rough = np.square((x - model.whole_mean) * float(model.n) - model.rest).sum(axis=1)
            fits = rough < 9.2e18
            gap = np.where(fits[:, None], x - model.whole_mean, 0) * model.n - np.where(fits[:, None], model.rest, 0)
            deviation = pa.array(np.square(gap).sum(axis=1), pa.int64(), mask=~fits)
            k = w.shape[1]
            whitened = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, whitened], ["key", "deviation", "whitened"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(project, f"key {kind}, deviation long, whitened array<double>")


def whitened(df, model, key="vec_id", vector="embedding"):
    """One row for each usable row of `df`: its key, `deviation` (null where 64 bits can't hold it) and `whitened`.

    Other columns are not read. Vectors of another length than the model's are left out.
    """
    base.ship(df.sparkSession)
    d = len(model.sums)
    rows, _ = usable_rows(df.where(F.size(vector) == d), key, vector)
    return _projected(rows, model, d).withColumnRenamed("key", key)


def whitening_report(df, key="vec_id", vector="embedding", count=COMPONENTS):
    """One row for each usable row and component: key, component (from 1), n, deviation, whitened, explained, identity_error.

    Null, short, long and non-finite vectors are left out (see `usable_rows`); null and repeated keys stay. An empty table,
    or one without a usable vector or with a single distinct one, gives an empty result.
    """
    model = fit(df, key, vector, count)
    if model is None:
        kind = df.schema[key].dataType.simpleString()
        schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], schema)
    explained = F.array(*[F.lit(float(share)) for share in model.explained]).cast("array<double>")
    rows = whitened(df, model, key, vector).select(key, "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        key,
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
