"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words that ignores some of them, so that two passages still meet where words were
substituted. Documents and benchmark are hashed under every mask; a filter of fixed size keeps what can't be in the
benchmark from being shuffled, the rest is joined by hash. Around each hit the passage of the document is laid beside the
item on the same diagonal and extended both ways over substitutions; long enough overlaps are contamination.
"""

import re

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from tallyhouse.llm import base

# Fixed masks: 1 looks at a word, 0 ignores it.
MASKS = ("11111", "1101101", "11010011", "101100011")
# An overlap: so many equal words at least, of which so large a share of its length; or a whole shorter item.
LEAST_EQUAL, LEAST_SHARE = 10, 0.7
# Items below this number of words are too common to be evidence and are left alone.
LEAST_ITEM = 5
# Score of an unequal word when extending, against 1 for an equal one; and how far below its best the score may fall.
UNEQUAL, DROP = -1, 6
# Words beside the outermost hits of a region that are looked at.
MARGIN = 64

_WORD = re.compile(r"\w+")


def word_codes(text):
    """Hashes of the lower-case words of a text, without punctuation."""
    return base.word_hashes([w.encode() for w in _WORD.findall(text.lower())]) if text else np.empty(0, np.uint64)


def seeds(codes):
    """(place, hash) of every mask at every place it fits."""
    places, hashes = [], []
    for number, mask in enumerate(MASKS):
        n = len(codes) - len(mask) + 1
        if n <= 0:
            continue
        out = np.full(n, number + 1, np.uint64)
        for at in np.flatnonzero([c == "1" for c in mask]):
            out = out * np.uint64(0x9E3779B97F4A7C15) + codes[at : at + n]
        places.append(np.arange(n))
        hashes.append(base.mixed(out))
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


def benchmark_seeds(benchmark):
    """Rows (item, codes, hash, place): an item's words come with each of its seeds. Equal texts are one item."""

    def scan(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"]):
                codes = word_codes(text)
                if len(codes) >= LEAST_ITEM:
                    places, hashes = seeds(codes)
                    rows += [(item, h, int(p)) for h, p in zip(hashes.view(np.int64).tolist(), places)]
            yield pd.DataFrame(rows, columns=["item", "hash", "place"])

    return benchmark.mapInPandas(scan, "item long, hash long, place int")


def _items(benchmark):
    """Distinct texts with the least item_id that has each."""
    own = benchmark.where("text is not null and item_id is not null")
    return own.groupBy("text").agg(F.min("item_id").alias("item")).select("item", "text")


REGION = "region string, doc_id long, text_key long, start int, codes binary, hashes array<long>, places array<int>"


def regions(docs, bits):
    """Stretches of documents around seeds that may be in the benchmark, with these seeds; near ones share a stretch."""

    def scan(batches):
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for doc, text, key in zip(batch["doc_id"], batch["text"], batch["text_key"]):
                codes = word_codes(text)
                places, hashes = seeds(codes)
                if not len(places):
                    continue
                hit = np.flatnonzero(base.maybe_member(bits.value, hashes))
                if not len(hit):
                    continue
                hit = hit[np.argsort(places[hit], kind="stable")]
                at = places[hit]
                for part in np.split(hit, np.flatnonzero(np.diff(at) > MARGIN) + 1):
                    first = max(0, int(places[part[0]]) - MARGIN)
                    last = int(places[part[-1]]) + MARGIN
                    rows.append((
                        f"{task}-{number}", None if pd.isna(doc) else int(doc), key, first, codes[first:last].tobytes(),
                        hashes[part].view(np.int64).tolist(), places[part].tolist(),
                    ))
                    number += 1
            frame = pd.DataFrame(rows, columns=["region", "doc_id", "text_key", "start", "codes", "hashes", "places"])
            yield frame.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInPandas(scan, REGION)


def best_overlap(own, item, shift):
    """(equal words, length, start in own) of the best stretch of own[i] against item[i - shift]."""
    low, high = max(0, shift), min(len(own), len(item) + shift)
    if high <= low:
        return 0, 0, low
    equal = own[low:high] == item[low - shift : high - shift]
    best = (0, 0, 0, low)
    score = count = 0
    start = low
    for at, same in enumerate(equal.tolist(), low):
        score += 1 if same else UNEQUAL
        count += same
        if score > best[0]:
            best = (score, count, at - start + 1, start)
        if score <= 0 or score < best[0] - DROP:
            score, count, start = 0, 0, at + 1
    return best[1], best[2], best[3]


def is_overlap(equal, length, item_length):
    """Whether so many equal words over such a length are contamination."""
    return equal >= min(LEAST_EQUAL, item_length) and equal >= LEAST_SHARE * length


def overlaps(docs, benchmark):
    """(doc_id, text_key, item, start, length, equal): verified overlaps, the best of each region and item.

    `start` and `length` count words of the document. `text_key` is xxhash64 of the text, which tells rows of equal ids
    apart. `docs` needs doc_id and text, `benchmark` item_id and text; null texts and ids of the benchmark are left out.
    """
    spark = docs.sparkSession
    base.ship(spark)
    items = _items(benchmark)
    known = base.stored(benchmark_seeds(items), "seeds")
    bits = base.membership_filter(known, "hash")
    found = base.stored(regions(docs, bits), "regions")
    hits = found.select("region", F.explode(F.arrays_zip("hashes", "places")).alias("s")).select(
        "region", F.col("s.hashes").alias("hash"), F.col("s.places").alias("at")
    )
    pairs = hits.join(known, "hash").select("region", "item", (F.col("at") - F.col("place")).alias("shift")).distinct()

    def verify(batches):
        for batch in batches:
            rows = []
            for doc, key, start, codes, item, text, shift in zip(
                batch["doc_id"], batch["text_key"], batch["start"], batch["codes"], batch["item"], batch["text"], batch["shift"]
            ):
                other = word_codes(text)
                equal, length, at = best_overlap(np.frombuffer(codes, np.uint64), other, shift - start)
                if is_overlap(equal, length, len(other)):
                    rows.append((None if pd.isna(doc) else int(doc), key, item, at + start, length, equal))
            frame = pd.DataFrame(rows, columns=["doc_id", "text_key", "item", "start", "length", "equal"])
            yield frame.astype({"doc_id": "Int64"})

    joined = pairs.join(found.select("region", "doc_id", "text_key", "start", "codes"), "region").join(items, "item")
    return joined.select("doc_id", "text_key", "start", "codes", "item", "text", "shift").mapInPandas(
        verify, "doc_id long, text_key long, item long, start int, length int, equal int"
    )


def contaminated(docs, benchmark):
    """(doc_id, text_key, items, n_equal) of the documents that hold benchmark passages."""
    return overlaps(docs, benchmark).groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.max("equal").cast("long").alias("n_equal")
    )


def contamination_report(docs, benchmark):
    """One row per document: doc_id, contaminated, items (benchmark items found in it), n_equal (words of the best overlap).

    A null or wordless text is not contaminated; nor is any if the benchmark is empty. Ids may be null or repeated. Rows
    of the benchmark with equal texts are reported under their least id. An empty table gives an empty result.
    """
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("c_doc"), "text_key", "items", "n_equal")
    own = docs.select("doc_id", F.xxhash64("text").alias("own_key"))
    met = own["doc_id"].eqNullSafe(found["c_doc"]) & (own["own_key"] == found["text_key"])
    return own.join(found, met, "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("n_equal", F.lit(0)).cast("long").alias("n_equal"),
    )


def without_contaminated(docs, benchmark):
    """The rows of `docs` that hold no benchmark passage, with all their columns."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("c_doc"), F.col("text_key").alias("c_key"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keyed = rows.select("row", F.col("row.doc_id").alias("id"), F.xxhash64("row.text").alias("key"))
    met = keyed["id"].eqNullSafe(found["c_doc"]) & (keyed["key"] == found["c_key"])
    return keyed.join(found, met, "left_anti").select("row.*")
