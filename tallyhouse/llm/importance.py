"""Target-distribution importance resampling: documents drawn by how much likelier the target makes their words.

1. Tasks count hashed features of the corpus and of the target into arrays of fixed size; their sums give each bucket's
   gain, a whole number. A document's weight is the floored mean of its gains, looked up in that array.
2. A Gumbel number of the id is added to the weight: the highest scores are a draw without replacement.
3. The cutoff needs no sort of all scores. Mergeable quantile sketches give a bracket around it; exact counts above and
   inside prove that the cutoff lies there, or the bracket is widened. Only the bracket is sorted to find it.
4. The ranks of what is drawn come from a range-sorted table, counts of its parts and their running sums.
"""

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.llm import base

RUNS = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# Width of the first bracket on both sides, as a share of the rows; each further one is four times as wide.
MARGIN = 0.005
# Entries per level of a quantile sketch: its rank error is about 0.1 %. Sketches of tasks merge in so many groups first.
SKETCH, SKETCH_GROUPS = 4096, 64
# Words whose bucket a Python worker remembers; beyond it the memory starts anew.
REMEMBERED = 1 << 17

# A-Z in lower case; 0-9, a-z and bytes from 0x80 belong to words, all others separate them.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class _Crcs(dict):
    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = zlib.crc32(word)
        return value


_CRC = _Crcs()


def words_of(text):
    """The words of a text as lower-case bytes; none of a null text."""
    return text.encode().translate(_BYTES).split() if text else []


def feature_buckets(words, runs=RUNS, buckets=BUCKETS):
    """Buckets of all runs of 1 to `runs` words, repeats included."""
    hashes = [np.fromiter(map(_CRC.__getitem__, words), np.int64, len(words))]
    for n in range(2, runs + 1):
        joined = [zlib.crc32(b" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]
        hashes.append(np.array(joined, np.int64))
    return np.concatenate(hashes) % buckets


def bucket_counts(texts, runs=RUNS, buckets=BUCKETS):
    """Features of all texts per bucket, as an array; only its fixed size reaches the driver."""

    def count(batches):
        table = np.zeros(buckets, np.int64)
        for batch in batches:
            found = [feature_buckets(words_of(text), runs, buckets) for text in batch["text"]]
            if found:
                table += np.bincount(np.concatenate(found), minlength=buckets)
        used = np.flatnonzero(table)
        yield pd.DataFrame({"bucket": used.astype(np.int32), "n": table[used]})

    table = np.zeros(buckets, np.int64)
    parts = texts.select("text").mapInPandas(count, "bucket int, n long")
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        table[row["bucket"]] = row["n"]
    return table


def gains(corpus, target):
    """floor(1000 * log of a bucket's share in the target over its share in the corpus), one added to each count."""
    corpus, target = corpus.astype(float), target.astype(float)
    buckets = len(corpus)
    ratio = (target + 1) * (corpus.sum() + buckets) / ((corpus + 1) * (target.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs, table, runs=RUNS, key="doc_id"):
    """Per row of `docs`: key, n_words, n_features and weight (0 without features), by the array of gains."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def weigh(batches):
        for batch in batches:
            out = []
            for text in batch["text"]:
                words = words_of(text)
                found = feature_buckets(words, runs, len(shared.value))
                n = len(found)
                out.append((len(words), n, int(shared.value[found].sum()) // n if n else 0))
            out = np.array(out, np.int64).reshape(-1, 3)
            yield pd.DataFrame({"key": batch["key"], "n_words": out[:, 0], "n_features": out[:, 1], "weight": out[:, 2]})

    # The key travels as text: a missing number would turn its column into floats.
    rows = docs.select(F.col(key).cast("string").alias("key"), "text")
    kept = rows.mapInPandas(weigh, "key string, n_words long, n_features long, weight long")
    return kept.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)


def scored(rows, seed=SEED, key="doc_id"):
    """`rows` with score: weight plus 1000 times a Gumbel number that the hash of seed and key fixes; null for a null key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return rows.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(share))).cast("long"))


def sketched_quantiles(rows, column, shares):
    """Values near the given quantiles of a column of whole numbers, from sketches merged in two levels."""
    groups = rows.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("part")).agg(
        F.kll_sketch_agg_bigint(column, SKETCH).alias("sketch")
    )
    one = groups.agg(F.kll_merge_agg_bigint("sketch").alias("s"))
    found = one.select(*[F.kll_sketch_get_quantile_bigint("s", F.lit(float(q))).alias(f"q{i}") for i, q in enumerate(shares)])
    return list(found.first())


def bracket(rows, column, wanted, total, margin=MARGIN):
    """(low, high, above): the `wanted`-th highest of `total` values lies within low..high, and `above` values are higher.

    A bound is None where the bracket reaches the end. The sketch only proposes; the counts are exact.
    """
    while True:
        middle = 1 - wanted / total
        shares = max(0.0, middle - margin), min(1.0, middle + margin)
        low, high = sketched_quantiles(rows, column, shares)
        low, high = low if shares[0] > 0 else None, high if shares[1] < 1 else None
        value = F.col(column)
        over = value > high if high is not None else F.lit(False)
        under = value < low if low is not None else F.lit(False)
        counts = rows.agg(F.count_if(over).alias("above"), F.count_if(~over & ~under).alias("inside")).first()
        if counts["above"] <= wanted <= counts["above"] + counts["inside"]:
            return low, high, counts["above"]
        margin *= 4


def numbered(rows, order, name="rank"):
    """`rows` numbered from 1 in the given order: range-sorted parts are written, their counts added up and joined.

    A part holds neighbours in the order; no task sees all rows, and the table of counts has a row for each part.
    """
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    table = base.stored(spread.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    # The high bits of such an id are the part, the low 33 bits the place in it.
    table = table.withColumn("_part", F.shiftright("_at", 33))
    parts = table.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_part").alias("_own"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    joined = table.join(F.broadcast(parts), F.col("_part") == F.col("_own"))
    return joined.withColumn(name, place.cast("long")).drop("_at", "_part", "_own", "_before")


def resampled(docs, target, *, runs=RUNS, buckets=BUCKETS, seed=SEED, least_words=LEAST_WORDS, percent=PERCENT, key="doc_id"):
    """One row for each row of `docs`: key, n_features, weight, score, rank (from 1 for the rows drawn, null for others).

    Of the N rows with a key and at least `least_words` words, floor(percent * N / 100) are drawn: the highest scores, ties
    to the smaller key; of repeated rows each counts, rows of equal score and key in order of their features. Null and empty
    texts have no feature, weight 0, and are never drawn; a null key has a null score and is not drawn. An empty corpus
    gives an empty result, an empty target gains that favour rare buckets. Columns other than key and text are not read.
    """
    base.ship(docs.sparkSession)
    table = gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    rows = base.stored(scored(weighted(docs, table, runs, key), seed, key), "scored")
    can = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    able = rows.where(can)
    total = able.count()
    wanted = percent * total // 100
    columns = [key, "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return rows.select(*columns, undrawn)
    low, high, above = bracket(able, "score", wanted, total)
    order = [F.desc("score"), F.asc(key), F.asc("n_features"), F.asc("weight")]
    over = F.col("score") > high if high is not None else F.lit(False)
    under = F.col("score") < low if low is not None else F.lit(False)
    inside = numbered(able.where(~over & ~under), order)
    drawn = F.when(F.col("rank") <= wanted - above, F.col("rank") + above).alias("rank")
    out = inside.select(*columns, drawn).union(rows.where(~can | under).select(*columns, undrawn))
    if above:
        out = out.union(numbered(able.where(over), order).select(*columns, "rank"))
    return out
