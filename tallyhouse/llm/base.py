"""What the operators share: folders, shipping the package, hashing words, merging sketches of partitions."""

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

ROOT = Path(__file__).resolve().parents[2]
SETTING = "spark.checkpoint.dir"

# Words whose hash a Python worker remembers; beyond it the memory starts anew.
REMEMBERED_WORDS = 1 << 18

_OWN_FOLDERS = {}
_SHIPPED = set()


def shared_folder(spark):
    """The folder in `spark.checkpoint.dir`, which all executors reach; a temporary one only where the master is local."""
    folder = spark.sparkContext.getConf().get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")
    application = spark.sparkContext.applicationId
    if application not in _OWN_FOLDERS:
        _OWN_FOLDERS[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _OWN_FOLDERS[application]


def stored(df, name):
    """Write `df` as Parquet in the shared folder and return it as read back: lineage ends here, lost executors lose nothing."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark):
    """Make this package importable in the Python workers where they don't find it by their own path."""
    places = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(":")]
    application = spark.sparkContext.applicationId
    if str(ROOT) in {os.path.realpath(p) for p in places if p} or application in _SHIPPED:
        return
    bundle = Path(tempfile.mkdtemp(prefix="run-"), "llm_bundle.zip")
    with zipfile.ZipFile(bundle, "w") as out:
        for path in (ROOT / "tallyhouse").rglob("*.py"):
            out.write(path, path.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(bundle))
    _SHIPPED.add(application)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_remainder(column, divisor):
    """crc32 of an id written as text, modulo `divisor`: the fold a row falls into. A null id falls into none."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def release_memory():
    """Give back what earlier operators left in this Python worker: remembered words, free pages of its allocators."""
    _HASHES.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def word_hashes(words):
    """64-bit hashes of words given as bytes."""
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def release_workers(spark):
    """Have the Python workers of all executors release what earlier stages left: a job of short tasks, some for each core."""
    ship(spark)

    def release(batches):
        release_memory()
        yield from batches

    tasks = 8 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).mapInArrow(release, "id long").write.format("noop").mode("overwrite").save()


# A word's hash is a polynomial of random numbers, one for each byte; white space counts as nothing, A-Z as a-z.
LONG_WORD = 64
BLOCK_BYTES = 1 << 16
_IN_WORD = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
_LETTERS = np.random.default_rng(12).integers(0, 1 << 64, 256, np.uint64) * _IN_WORD
_LETTERS[65:91] = _LETTERS[97:123]
_BASE = 0x9E3779B97F4A7C1B


def _powers(base, n):
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWERS = _powers(_BASE, BLOCK_BYTES + LONG_WORD)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), BLOCK_BYTES)


def text_word_hashes(text):
    """64-bit hashes of a text's words between ASCII white space, A-Z in lower case, from running sums over its bytes.

    Words above `LONG_WORD` bytes are hashed one by one.
    """
    data = np.frombuffer(b" %b " % text.encode(), np.uint8)
    inside = _IN_WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    out = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + BLOCK_BYTES, BLOCK_BYTES))
    for number, (first, last) in enumerate(zip(cuts[:-1], cuts[1:])):
        if first == last:
            continue
        offset = number * BLOCK_BYTES
        own = _LETTERS[data[offset : offset + BLOCK_BYTES + LONG_WORD]]
        own *= _POWERS[: len(own)]
        sums = np.cumsum(own)
        begins = starts[first:last] - offset
        before = np.where(begins > 0, sums[begins - 1], np.uint64(0))
        stops = np.minimum(ends[first:last] - offset, len(own))
        out[first:last] = (sums[stops - 1] - before) * _INVERSE[begins]
    out = mixed(out)
    for at in np.flatnonzero(ends - starts > LONG_WORD):
        out[at] = xxh3_64_intdigest(data[starts[at] : ends[at]].tobytes().lower())
    return out


def mixed(values):
    """A one-to-one scrambling of 64-bit values, so that any bits of them are evenly spread."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def run_hashes(values, width, factor=0x9E3779B97F4A7C15):
    """Hashes of all runs of `width` consecutive values; empty if there are fewer values."""
    if len(values) < width:
        return np.empty(0, np.uint64)
    out = values[: len(values) - width + 1].copy()
    for shift in range(1, width):
        out *= np.uint64(factor)
        out += values[shift : len(values) - width + 1 + shift]
    return mixed(out)


# --- sketches -----------------------------------------------------------------------------------------------------

SLICES = 32
SLICE_SCHEMA = "slice int, cells binary"


def slices_of(table):
    """Cut one partition's sketch, an array, into rows (slice, bytes), leaving out slices without a count."""
    for number, part in enumerate(np.split(table, SLICES)):
        if part.any():
            yield number, part.tobytes()


def merged_sketch(rows, width, dtype, merge, finish=None):
    """Merge slices of all partitions on the executors, a row at a time as they stream by.

    The result has `width` cells whatever the input, so it may be collected and sent to all tasks. `merge` adds the
    second array to the first; `finish` turns a merged slice into the array that is kept.
    """
    dtype = np.dtype(dtype)

    def streamed(batches):
        tables = {}
        for batch in batches:
            for number, cells in zip(batch["slice"], batch["cells"]):
                if number not in tables:
                    tables[number] = np.zeros(width // SLICES, dtype)
                merge(tables[number], np.frombuffer(cells, dtype))
        for number, table in tables.items():
            kept = finish(table) if finish else table
            yield pd.DataFrame({"slice": [number], "cells": [kept.tobytes()]})

    merged = rows.select("slice", "cells").repartition(SLICES, "slice").mapInPandas(streamed, SLICE_SCHEMA).collect()
    kept = finish(np.zeros(width // SLICES, dtype)) if finish else np.zeros(width // SLICES, dtype)
    parts = [kept] * SLICES
    for row in merged:
        parts[row["slice"]] = np.frombuffer(row["cells"], kept.dtype)
    return np.concatenate(parts)


def add_saturating(table, more):
    """Add unsigned counts, staying at the largest value instead of wrapping round."""
    room = np.iinfo(table.dtype).max - table
    table += np.minimum(more, room)


# Bits of a membership filter. Its size is fixed: a fuller filter lets more values pass and drops none.
FILTER_BITS = 1 << 25


def _filter_spots(values):
    spread = mixed(values)
    return np.concatenate([((spread >> np.uint64(s)) % np.uint64(FILTER_BITS)).astype(np.int64) for s in (0, 13, 26)])


def membership_filter(df, *columns):
    """A filter of the 64-bit values in `columns`, made on the executors and broadcast; see `maybe_member`."""

    def bits(batches):
        table = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            for column in columns:
                spots = _filter_spots(batch[column].dropna().to_numpy(np.int64).view(np.uint64))
                np.bitwise_or.at(table, spots >> 3, (1 << (spots & 7)).astype(np.uint8))
        yield pd.DataFrame(list(slices_of(table)), columns=["slice", "cells"])

    def join_bits(table, more):
        np.bitwise_or(table, more, out=table)

    rows = df.select(*columns).mapInPandas(bits, SLICE_SCHEMA)
    return df.sparkSession.sparkContext.broadcast(merged_sketch(rows, FILTER_BITS // 8, np.uint8, join_bits))


def maybe_member(bits, values):
    """Which of the values (unsigned 64-bit) may be in the filter; those that are always pass."""
    spots = _filter_spots(values)
    return (bits[spots >> 3] >> (spots & 7).astype(np.uint8) & 1).astype(bool).reshape(3, -1).all(axis=0)


# --- learning -----------------------------------------------------------------------------------------------------


def bounded_sample(rows, label, per_class, key="doc_id"):
    """About `per_class` rows of each value of `label` (all, where there are fewer), picked by a hash of `key`.

    Repeatable and independent of partitioning. Rows with a null label or key are left out.
    """
    rows = rows.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    sizes = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    steps = 1 << 30
    picked = F.lit(False)
    for value in sorted(sizes):
        share = min(steps, int(steps * per_class / sizes[value]))
        picked = picked | ((F.col(label) == F.lit(value)) & (F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(steps)) < share))
    return rows.where(picked), sizes
