"""N-gram Jaccard join: rare-first prefix filtering, each candidate pair verified once, and the groups it links.

Exact: two documents link when `100 * |x & y| >= percent * |x | y|` for their sets of word n-grams (as 64-bit hashes).

1. One scan makes each document's set, a signature of it and a sketch of how common n-grams are; copies share a signature.
2. A second scan orders each set rare first (by the merged sketch, then by hash: one order for all) and gives out the
   prefix, which must meet the prefix of any partner. Entries travel as blocks per bucket of the hash.
3. In a bucket, entries of one n-gram pair up if lengths and positions still allow the wanted overlap. Where more than
   `SMALL` sets share an n-gram, only pairs with one pivot come out first: the set with the fewest rarer n-grams, that
   is, the least changed of a group of copies, by way of which the others mostly fall into one group. What stays apart
   afterwards is paired in further turns, and at last pair by pair. No pair that could link two groups is left out.
4. The distinct pairs meet their sets once: suffix filter, then the exact count.
"""

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tallyhouse.llm import base
from tallyhouse.llm.components import connected

WIDTH = 5
PERCENT = 75

# Cells of the sketch that orders n-grams: its size does not grow with the input. A fuller sketch orders more coarsely.
ORDER_CELLS = 1 << 23
# Cells a task gathers before it counts them.
GATHERED = 1 << 20
# Sets sharing an n-gram that are paired at once; larger groups begin with a pivot.
SMALL = 12
# Turns with a pivot before the rest is paired in full.
PIVOT_TURNS = 1
# 64-bit words of a set's parity marks, which bound how far two sets are apart before they are paired.
MARKS = 16
# Entries a task holds before it gives them out, and entries a bucket should have.
HELD, BUCKET_ENTRIES = 500_000, 500_000
BUCKETS_AT_LEAST = 64

SET_SCHEMA = "doc_id long, text_key long, n_shingles long, signature long, slice int, cells binary"
PAIR = "a_sig long, a_n long, b_sig long, b_n long"


def shingles(text, width=WIDTH):
    """The sorted distinct hashes of a text's word n-grams; a shorter text is one n-gram, a text without words none."""
    hashes = base.text_word_hashes(text) if text else ()
    if not len(hashes):
        return np.empty(0, np.uint64)
    if len(hashes) < width:
        return base.run_hashes(hashes, len(hashes)) ^ np.uint64(len(hashes))
    grams = np.sort(base.run_hashes(hashes, width))
    fresh = np.ones(len(grams), bool)
    np.not_equal(grams[1:], grams[:-1], out=fresh[1:])
    return grams[fresh]


def signature(grams):
    return struct.unpack("<q", struct.pack("<Q", xxh3_64_intdigest(grams.tobytes())))[0]


def _cells(grams):
    return (grams >> np.uint64(40)).astype(np.int64) % ORDER_CELLS


def scan_sets(docs, width=WIDTH):
    """Per document its id, set size and signature; after them the partition's sketch in slices."""

    def scan(batches):
        # A task counts to 15, so that two cells go into a byte; the merged sketch counts on.
        counts, gathered, held = np.zeros(ORDER_CELLS, np.uint8), [], 0

        def counted():
            cells, times = np.unique(np.concatenate(gathered), return_counts=True)
            counts[cells] = np.minimum(counts[cells] + times, 15)

        for batch in batches:
            sizes, signs = [], []
            for text in batch["text"]:
                grams = shingles(text, width)
                sizes.append(len(grams))
                signs.append(signature(grams) if len(grams) else None)
                gathered.append(_cells(grams).astype(np.uint32))
                held += len(grams)
                if held >= GATHERED:
                    counted()
                    gathered, held = [], 0
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"),
                "text_key": batch["text_key"],
                "n_shingles": sizes,
                "signature": pd.array(signs, "Int64"),
                "slice": pd.array([None] * len(sizes), "Int32"),
                "cells": None,
            })
        if held:
            counted()
        parts = list(base.slices_of(counts[0::2] << 4 | counts[1::2]))
        if parts:
            yield pd.DataFrame({
                "doc_id": pd.array([None] * len(parts), "Int64"),
                "text_key": pd.array([None] * len(parts), "Int64"),
                "n_shingles": pd.array([None] * len(parts), "Int64"),
                "signature": pd.array([None] * len(parts), "Int64"),
                "slice": pd.array([p[0] for p in parts], "Int32"),
                "cells": [p[1] for p in parts],
            })

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInPandas(scan, SET_SCHEMA)


def prefix_length(n, percent):
    """Members of a set of n that must hold one of any partner's own prefix."""
    return n - -(-percent * n // 100) + 1


def _unpack(block):
    n = len(block) // 24
    return (
        np.frombuffer(block, np.uint64, n),
        np.frombuffer(block, np.int64, n, 8 * n),
        np.frombuffer(block, np.uint32, n, 16 * n),
        np.frombuffer(block, np.uint32, n, 20 * n),
    )


def prefix_entries(docs, common, buckets, width=WIDTH, percent=PERCENT):
    """Blocks (bucket, entries) of the prefixes; an entry is n-gram, signature, set size, place in the rare-first order.

    A set that a task has already given out is not given out again.
    """

    def scan(batches):
        seen, parts, held = set(), [], 0

        def given_out():
            grams = np.concatenate([p[0] for p in parts])
            bucket = (grams % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            chosen = [b for b in range(buckets) if edges[b] < edges[b + 1]]
            columns = [np.concatenate([p[k] for p in parts])[order] for k in range(4)]
            return pd.DataFrame({
                "bucket": np.array(chosen, np.int32),
                "entries": [b"".join(c[edges[b] : edges[b + 1]].tobytes() for c in columns) for b in chosen],
            })

        for batch in batches:
            for text in batch["text"]:
                grams = shingles(text, width)
                n = len(grams)
                if not n:
                    continue
                sign = signature(grams)
                if sign in seen:
                    continue
                seen.add(sign)
                take = prefix_length(n, percent)
                chosen = grams[np.argsort(common.value[_cells(grams)], kind="stable")[:take]]
                parts.append((
                    chosen, np.full(take, sign, np.int64), np.full(take, n, np.uint32), np.arange(take, dtype=np.uint32),
                ))
                held += take
                if held >= HELD:
                    yield given_out()
                    parts, held = [], 0
        if parts:
            yield given_out()

    return docs.select("text").mapInPandas(scan, "bucket int, entries binary")


def _may_link(n_a, p_a, n_b, p_b, percent):
    """Length filter and positional filter, p being the place of a shared member in the rare-first order."""
    low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    wanted = -(-percent * (n_a + n_b) // (100 + percent))
    return (100 * low >= percent * high) & (np.minimum(n_a - p_a, n_b - p_b) >= wanted)


def _pairs_frame(sign, size, left, right):
    """Distinct pairs of set numbers, the smaller signature first."""
    swap = sign[left] > sign[right]
    left, right = np.where(swap, right, left), np.where(swap, left, right)
    frame = pd.DataFrame({"a_sig": sign[left], "a_n": size[left], "b_sig": sign[right], "b_n": size[right]})
    return frame.drop_duplicates(["a_sig", "b_sig"])


def pair_up(entries, percent=PERCENT):
    """From blocks of entries: candidate pairs, and the members of n-grams that more than SMALL sets share."""

    def in_bucket(rows):
        blocks = [_unpack(block) for block in rows["entries"]]
        gram, sign, size, place = (np.concatenate([b[k] for b in blocks]) for k in range(4))
        size, place = size.astype(np.int64), place.astype(np.int64)
        order = np.lexsort((sign, gram))
        gram, sign, size, place = gram[order], sign[order], size[order], place[order]
        fresh = np.ones(len(gram), bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (sign[1:] != sign[:-1])
        gram, sign, size, place = gram[fresh], sign[fresh], size[fresh], place[fresh]
        starts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        counts = np.diff(np.r_[starts, len(gram)])
        begin, count = np.repeat(starts, counts), np.repeat(counts, counts)
        index = np.arange(len(gram))
        left, right = [], []
        for step in range(1, SMALL):
            one = index[(count <= SMALL) & (index - begin + step < count)]
            left.append(one)
            right.append(one + step)
        crowded = count > SMALL
        large = np.flatnonzero(counts > SMALL)
        if len(large):
            rank = base.mixed(sign.view(np.uint64))
            for at in large:
                span = np.arange(starts[at], starts[at] + counts[at])
                pivot = span[np.lexsort((rank[span], place[span]))[0]]
                rest = span[span != pivot]
                left.append(np.full(len(rest), pivot))
                right.append(rest)
                # Every pair of the pivot is out now.
                crowded[pivot] = False
        left, right = np.concatenate(left), np.concatenate(right)
        keep = _may_link(size[left], place[left], size[right], place[right], percent)
        pairs = _pairs_frame(sign, size, left[keep], right[keep])
        members = np.flatnonzero(crowded)
        crowd = pd.DataFrame({
            "a_sig": sign[members], "a_n": size[members], "gram": gram[members].view(np.int64), "place": place[members],
        })
        # Absent values must not turn 64-bit numbers into floats.
        columns = ["a_sig", "a_n", "b_sig", "b_n", "gram", "place"]
        whole = [frame.astype("Int64").reindex(columns=columns).astype("Int64") for frame in (pairs, crowd)]
        return pd.concat(whole)

    return entries.groupBy("bucket").applyInPandas(in_bucket, f"{PAIR}, gram long, place long")


def suffix_allows(x, y, wanted, depth=3):
    """Whether |x & y| >= wanted is still possible, judged by splitting both sorted sets at the same value."""
    spare = len(x) + len(y) - 2 * wanted

    def apart(x, y, depth):
        if not depth or not len(x) or not len(y):
            return abs(len(x) - len(y))
        middle = y[len(y) // 2]
        cut_x, cut_y = int(np.searchsorted(x, middle)), len(y) // 2
        return apart(x[:cut_x], y[:cut_y], depth - 1) + apart(x[cut_x:], y[cut_y:], depth - 1)

    return apart(x, y, depth) <= spare


def linked(x, y, percent=PERCENT):
    """The exact test of two sorted sets."""
    wanted = -(-percent * (len(x) + len(y)) // (100 + percent))
    if not suffix_allows(x, y, wanted):
        return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= wanted


def sets_of(docs, texts, width=WIDTH):
    """(sign, grams) of the documents whose text_key is in `texts`, and of few others that a full filter lets pass."""
    wanted = base.membership_filter(texts, "text_key")

    def scan(batches):
        seen = set()
        for batch in batches:
            found = []
            fits = base.maybe_member(wanted.value, batch["text_key"].to_numpy(np.int64).view(np.uint64))
            for text in batch["text"][fits]:
                grams = shingles(text, width)
                if not len(grams):
                    continue
                sign = signature(grams)
                if sign not in seen:
                    seen.add(sign)
                    found.append((sign, grams.tobytes()))
            yield pd.DataFrame(found, columns=["sign", "grams"])

    return docs.select("text", F.xxhash64("text").alias("text_key")).mapInPandas(scan, "sign long, grams binary")


def stored_sets(docs, sets, signs, width=WIDTH):
    """Table (sign, grams) of the sets named by `signs`, each once: of all texts that have a set, one is read again."""
    own = sets.where("signature is not null").join(signs, sets["signature"] == signs["sign"], "left_semi")
    texts = own.groupBy("signature").agg(F.min("text_key").alias("text_key"))
    return base.stored(sets_of(docs, texts, width).groupBy("sign").agg(F.min("grams").alias("grams")), "sets")


def verified(sets, pairs, percent=PERCENT):
    """Those of the distinct candidate pairs that truly link, as (a, b)."""

    def check(batches):
        for batch in batches:
            keep = [
                linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(batch["x"], batch["y"])
            ]
            yield batch.loc[keep, ["a", "b"]]

    left = sets.select(F.col("sign").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("sign").alias("b"), F.col("grams").alias("y"))
    pairs = pairs.select(F.col("a_sig").alias("a"), F.col("b_sig").alias("b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(check, "a long, b long")


def _apart(crowd, labels):
    """Members of crowded n-grams whose sets are still in more than one group, with the group of each."""
    own = crowd.join(labels, crowd["a_sig"] == labels["node"], "left").select(
        *crowd.columns, F.coalesce("label", "a_sig").alias("label")
    )
    own = base.stored(own, "crowd")
    open_grams = own.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_grams = base.stored(open_grams.where("low <> high").select("gram"), "open")
    return base.stored(own.join(open_grams, "gram", "left_semi"), "apart")


def _fits(percent):
    """SQL form of the length, positional and suffix filters for rows l and r.

    Where parity marks differ, a member is in one set only; so they can't differ in more places than two sets with the
    wanted overlap do.
    """
    apart = " + ".join(f"bit_count(l.m{i} ^ r.m{i})" for i in range(MARKS))
    return (
        f"100 * least(l.a_n, r.a_n) >= {percent} * greatest(l.a_n, r.a_n) and "
        f"({100 + percent}) * least(l.a_n - l.place, r.a_n - r.place) >= {percent} * (l.a_n + r.a_n) and "
        f"{apart} <= l.a_n + r.a_n - 2 * (({percent} * (l.a_n + r.a_n) + {99 + percent}) div {100 + percent})"
    )


def parity_marks(grams):
    """MARKS numbers of 64 bits: a bit says whether an odd number of the set's members fall on it."""
    bits = np.bincount((base.mixed(grams) % np.uint64(64 * MARKS)).astype(np.int64), minlength=64 * MARKS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _with_marks(crowd, sets):
    """Crowd rows with the parity marks of their sets."""

    def scan(batches):
        for batch in batches:
            found = np.array([parity_marks(np.frombuffer(g, np.uint64)) for g in batch["grams"]]).reshape(-1, MARKS)
            yield pd.DataFrame({"sign": batch["sign"], **{f"m{i}": found[:, i] for i in range(MARKS)}})

    schema = "sign long, " + ", ".join(f"m{i} long" for i in range(MARKS))
    marks = base.stored(sets.mapInPandas(scan, schema), "marks")
    return base.stored(crowd.join(marks, crowd["a_sig"] == marks["sign"]).drop("sign"), "crowd")


def _oriented(pairs):
    """Candidate pairs of rows l and r as distinct (a_sig, a_n, b_sig, b_n)."""
    swap = F.col("l.a_sig") > F.col("r.a_sig")
    pick = lambda name, first, second: F.when(swap, F.col(second)).otherwise(F.col(first)).alias(name)
    return pairs.select(
        pick("a_sig", "l.a_sig", "r.a_sig"), pick("a_n", "l.a_n", "r.a_n"),
        pick("b_sig", "r.a_sig", "l.a_sig"), pick("b_n", "r.a_n", "l.a_n"),
    ).distinct()


def add_halves(table, more):
    """Add a task's counts, two to a byte, to the merged counts, which stay at their largest value."""
    base.add_saturating(table[0::2], more >> 4)
    base.add_saturating(table[1::2], more & 15)


def links(docs, sets, width=WIDTH, percent=PERCENT):
    """(links, labels): verified links between signatures that together give all groups, and the groups' labels."""
    spark = docs.sparkSession
    common = base.merged_sketch(sets.where("slice is not null"), ORDER_CELLS, np.uint8, add_halves)
    common = spark.sparkContext.broadcast(common)
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(BUCKETS_AT_LEAST, int(total * (100 - percent) / 100 / BUCKET_ENTRIES))
    found = base.stored(pair_up(prefix_entries(docs, common, buckets, width, percent), percent), "pairs")
    pairs = base.stored(
        found.where("gram is null").groupBy("a_sig", "b_sig").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n")),
        "candidates",
    )
    named = pairs.select(F.col("a_sig").alias("sign")).union(pairs.select("b_sig"))
    proven = base.stored(verified(stored_sets(docs, sets, named, width), pairs, percent), "links")
    labels = base.stored(connected(proven), "labels")
    crowd = _apart(found.where("gram is not null").select("gram", "a_sig", "a_n", "place"), labels)
    if crowd.isEmpty():
        return proven, labels
    # Sets of all further turns come from one more scan.
    grams = stored_sets(docs, sets, crowd.select(F.col("a_sig").alias("sign")), width)
    crowd = _with_marks(crowd, grams)
    tried = pairs.select("a_sig", "b_sig")
    for turn in range(PIVOT_TURNS + 1):
        if turn < PIVOT_TURNS:
            others = [c for c in crowd.columns if c not in ("gram", "place", "a_sig")]
            rank = F.struct("place", F.xxhash64("a_sig").alias("tie"), "a_sig", *others)
            pivots = base.stored(crowd.groupBy("gram").agg(F.min(rank).alias("p")).select("gram", "p.*").drop("tie"), "pivots")
            met = crowd.alias("l").join(pivots.alias("r"), F.expr(f"l.gram = r.gram and l.label <> r.label and {_fits(percent)}"))
        else:
            met = crowd.alias("l").join(
                crowd.alias("r"),
                F.expr(f"l.gram = r.gram and l.a_sig < r.a_sig and l.label <> r.label and {_fits(percent)}"),
            )
        more = base.stored(_oriented(met).join(tried, ["a_sig", "b_sig"], "left_anti"), "candidates")
        tried = tried.union(more.select("a_sig", "b_sig"))
        new = base.stored(verified(grams, more, percent), "links")
        if not new.isEmpty():
            # Labels are links too, and give the same groups as the links they came from.
            proven = proven.union(new)
            labels = base.stored(connected(new.union(labels.select("node", "label"))), "labels")
        if turn == PIVOT_TURNS:
            break
        # All pairs of a pivot within its n-gram are decided; the others go on while their n-gram has several groups.
        left = crowd.drop("label").join(pivots.select("gram", "a_sig"), ["gram", "a_sig"], "left_anti")
        crowd = _apart(left, labels)
        if crowd.isEmpty():
            break
    return proven, labels


def near_duplicate_groups(docs, width=WIDTH, percent=PERCENT):
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable over links, its own included),
    and text_key (xxhash64 of the text, which tells rows of equal ids apart).

    `docs` needs doc_id and text, other columns are not read. A null text and a text without words have the empty set,
    which links with nothing. Copies, repeated rows included, are one set and never paired. A null doc_id does not
    count as smallest; a group of null ids only has a null component_id. An empty table gives an empty result.
    """
    base.ship(docs.sparkSession)
    sets = base.stored(scan_sets(docs, width), "sets")
    _, labels = links(docs, sets, width, percent)
    own = sets.where("slice is null").select("doc_id", "text_key", "n_shingles", "signature")
    own = own.join(labels, own["signature"] == labels["node"], "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("label", "signature").alias("label")
    )
    own = base.stored(own, "labelled")
    groups = own.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    groups = base.stored(groups.where("n > 1").select("label", "low"), "groups")
    return own.join(groups, "label", "left").select(
        "doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id"), "text_key"
    )


def one_per_group(docs, width=WIDTH, percent=PERCENT):
    """The rows of `docs` with all their columns, of each group only the document of smallest id.

    Documents without words stay. Repeated rows (equal id and text) count as copies: one stays. A document of null id goes
    if its group has an id. Cases as in `near_duplicate_groups`.
    """
    found = near_duplicate_groups(docs, width, percent)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("g_id"), F.col("text_key").alias("g_key")
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keyed = rows.select("row", F.col("row.doc_id").alias("id"), F.xxhash64("row.text").alias("key"))
    kept = keyed.join(gone, keyed["id"].eqNullSafe(gone["g_id"]) & (keyed["key"] == gone["g_key"]), "left_anti")
    # Rows of equal id and text lie together already.
    again = F.row_number().over(Window.partitionBy("id", "key").orderBy("key"))
    return kept.withColumn("again", again).where(
        "again = 1 or row.text is null or not row.text rlike '[^\\\\x20\\\\x09-\\\\x0D]'"
    ).select("row.*")
