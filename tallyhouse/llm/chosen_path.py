"""MinHash near-dedup: a similarity join along chosen paths, confirmed on full sets, and the groups it links.

1. One scan makes each document's set of word n-grams, its signature (copies share it) and its minwise sketch.
2. A tree branches a set at each node by `FAN` coordinates of the sketch, which the hash of the node chooses: the child is
   named by the minwise token found there. So a set computes its own paths, and similar sets share some. With a share p of
   equal coordinates, a pair survives in a tree of any depth with probability (2p - 1) / p^2 for a fan of two; as many
   independent trees grow as the target recall asks for.
3. Sets that meet in a small node are candidates all with all, by bits of their sketches. In a larger node they first meet
   one pivot, so that a group of copies costs one pair for each copy. Candidates are confirmed on full sets.
4. Nodes that then hold sets of one group only are closed. Nodes above `LIMIT` sets branch on, for at most `ROUNDS` turns. The
   others are settled: their sets come together by pivot (nodes of one group mostly share it, so a set travels once, not
   once a node), and sets of different groups are compared in memory, sketches first, full sets where these allow it.
   Only links leave a task. What is above the limit even after the last turn is settled in pairs of blocks.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallyhouse.llm import base
from tallyhouse.llm.components import connected
from tallyhouse.llm.ngram_join import shingles, signature, stored_sets

WIDTH = 2
PERCENT = 80
# Share of the pairs just at the threshold that some tree must bring together.
RECALL = 0.9999
# Coordinates of a sketch, and levels that a tree branches in one turn.
COORDINATES, LEVELS = 128, 3
FAN = 2
# Sets of a node that are candidates all with all at once; sets of a node, or of a block, that a task compares in memory.
SMALL, LIMIT = 12, 2048
# Turns in which large nodes branch on, and levels of each.
ROUNDS, DEEPER = 3, 2
# A pair is dropped unread if its sketches agree in fewer bits, or in fewer tokens, than linked sets do: five and four
# standard deviations below what pairs at the threshold do, so that the loss stays below what the recall allows.
BITS = 64
BIT_DEVIATIONS, TOKEN_DEVIATIONS = 5.0, 4.0
# N-grams whose hashes are computed at once, entries a task holds before it gives them out, and entries of a bucket.
CHUNK, HELD, BUCKET_ENTRIES = 4096, 500_000, 500_000
BUCKETS_AT_LEAST = 64
# N-grams of sets that a task holds when it settles units, about, and sets whose full sets are compared at once.
BUCKET_GRAMS, AT_ONCE = 4_000_000, 32

_DRAWN = np.random.default_rng(13)
_FACTORS = _DRAWN.integers(0, 1 << 31, COORDINATES, np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _DRAWN.integers(0, 1 << 32, COORDINATES, np.uint32)

SET_SCHEMA = "doc_id long, text_key long, n_shingles long, signature long, sketch binary"
ENTRY = [("node", np.uint64), ("sig", np.int64), ("bits", np.uint64), ("size", np.uint32)]
FOUND_SCHEMA = "a long, b long, node long, pivot long, sig long, size long"
LINK_SCHEMA = "a long, b long"


def trees_for(recall, percent):
    """Trees needed so that a pair at the threshold shares a node of some tree with probability `recall`."""
    p = percent / 100
    lost = 1 - (2 * p - 1) / p**2
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def least_agreement(places, share, deviations):
    """Of `places` that agree with probability `share` each, the number that agree but for a few in many cases."""
    return math.floor(places * share - deviations * math.sqrt(places * share * (1 - share)))


def sketch(grams):
    """Minwise tokens: for each coordinate the least value of its own permutation of 32-bit hashes."""
    short = (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), CHUNK):
        values = short[at : at + CHUNK] * _FACTORS[:, None]
        values += _SHIFTS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def scan_sets(docs, width=WIDTH):
    """Per document its id, text key, set size, signature and sketch; the last two are null for an empty set."""

    def scan(batches):
        for batch in batches:
            sizes, signs, sketches = [], [], []
            for text in batch["text"]:
                grams = shingles(text, width)
                sizes.append(len(grams))
                signs.append(signature(grams) if len(grams) else None)
                sketches.append(sketch(grams).tobytes() if len(grams) else None)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "text_key": batch["text_key"], "n_shingles": sizes,
                "signature": pd.array(signs, "Int64"), "sketch": sketches,
            })

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInPandas(scan, SET_SCHEMA)


def first_bits(sketches):
    """A 64-bit number per row of sketches: one bit of each of its first 64 tokens."""
    bits = (sketches[:, :BITS] >> np.uint32(16) & np.uint32(1)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


def branched(nodes, sketches, levels):
    """Paths of rows of sketches from one node each: a row of FAN ** levels nodes. The node's hash picks the coordinates."""
    paths = nodes.reshape(-1, 1)
    rows = np.arange(len(sketches))[:, None]
    for _ in range(levels):
        children = []
        first = base.mixed(paths) % np.uint64(COORDINATES)
        for branch in range(FAN):
            # Branches of a node pick different coordinates.
            spot = (first + np.uint64(branch * (COORDINATES // FAN))) % np.uint64(COORDINATES)
            token = sketches[rows, spot.astype(np.int64)].astype(np.uint64)
            step = token << np.uint64(32) | spot << np.uint64(1) | np.uint64(1)
            children.append(base.mixed(paths * np.uint64(0x9E3779B97F4A7C15) ^ base.mixed(step)))
        paths = np.hstack(children)
    return paths


def _blocks(columns, buckets):
    """Entries, given as columns, cut into one block of bytes per bucket of the node."""
    columns = [np.ascontiguousarray(c, kind) for c, (_, kind) in zip(columns, ENTRY)]
    bucket = (base.mixed(columns[0]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    chosen, starts = np.unique(bucket[order], return_index=True)
    edges = np.r_[starts, len(order)]
    columns = [c[order] for c in columns]
    blocks = [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(edges[:-1], edges[1:])]
    return pd.DataFrame({"bucket": chosen.astype(np.int32), "entries": blocks})


def _entries(blocks):
    """Entries of all blocks as columns, sorted by node and signature, each pair of these once."""
    width = sum(np.dtype(kind).itemsize for _, kind in ENTRY)
    parts = [[] for _ in ENTRY]
    for block in blocks:
        n, at = len(block) // width, 0
        for part, (_, kind) in zip(parts, ENTRY):
            part.append(np.frombuffer(block, kind, n, at))
            at += n * np.dtype(kind).itemsize
    node, sig, bits, size = (np.concatenate(p) for p in parts)
    order = np.lexsort((sig, node))
    node, sig, bits, size = node[order], sig[order], bits[order], size[order]
    fresh = np.ones(len(node), bool)
    fresh[1:] = (node[1:] != node[:-1]) | (sig[1:] != sig[:-1])
    return node[fresh], sig[fresh], bits[fresh], size[fresh].astype(np.int64)


def path_entries(rows, from_root, levels, buckets, trees):
    """Blocks (bucket, entries) of the nodes that sets reach in `levels` further levels.

    `rows` hold signature, n_shingles, sketch and, unless `from_root`, the node to start from. A task gives a set of the
    first turn out only once.
    """
    roots = base.mixed(np.arange(1, trees + 1, dtype=np.uint64))

    def scan(batches):
        seen, parts, held = set(), [], 0
        for batch in batches:
            if from_root:
                fresh = [sign not in seen and not seen.add(sign) for sign in batch["signature"]]
                batch = batch[fresh]
            if not len(batch):
                continue
            sketches = np.frombuffer(b"".join(batch["sketch"]), np.uint32).reshape(-1, COORDINATES)
            sig, size = batch["signature"].to_numpy(np.int64), batch["n_shingles"].to_numpy(np.int64)
            bits = first_bits(sketches)
            starts = [np.full(len(sig), root) for root in roots] if from_root else [batch["node"].to_numpy(np.int64).view(np.uint64)]
            for start in starts:
                paths = branched(start, sketches, levels)
                times = paths.shape[1]
                parts.append((paths.ravel(), np.repeat(sig, times), np.repeat(bits, times), np.repeat(size, times)))
                held += paths.size
            if held >= HELD:
                yield _blocks([np.concatenate(c) for c in zip(*parts)], buckets)
                parts, held = [], 0
        if parts:
            yield _blocks([np.concatenate(c) for c in zip(*parts)], buckets)

    return rows.mapInPandas(scan, "bucket int, entries binary")


def may_link(size_a, bits_a, size_b, bits_b, percent):
    """Length filter and agreement of sketch bits; unequal tokens agree in half of the bits."""
    low, high = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    least = least_agreement(BITS, (1 + percent / 100) / 2, BIT_DEVIATIONS)
    return (100 * low >= percent * high) & (BITS - np.bitwise_count(bits_a ^ bits_b).astype(np.int64) >= least)


def _found(pairs, members):
    """Rows of pairs (a, b) and rows of members (node, pivot, sig, size) in one frame."""
    a, b = pairs
    pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()
    node, pivot, sig, size = members
    members = pd.DataFrame({"node": node.view(np.int64), "pivot": pivot, "sig": sig, "size": size})
    # Absent values must not turn 64-bit numbers into floats.
    columns = ["a", "b", "node", "pivot", "sig", "size"]
    return pd.concat([f.astype("Int64").reindex(columns=columns).astype("Int64") for f in (pairs, members)])


def met(entries, percent):
    """From blocks: candidate pairs (a, b), and the members (node, pivot, sig, size) of nodes of more than SMALL sets.

    The pivot of a large node is its set of least scrambled signature: nodes that share sets mostly share the pivot.
    """

    def in_bucket(rows):
        node, sig, bits, size = _entries(rows["entries"])
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        counts = np.diff(np.r_[starts, len(node)])
        begin, count = np.repeat(starts, counts), np.repeat(counts, counts)
        index = np.arange(len(node))
        left, right = [], []
        for step in range(1, SMALL):
            one = index[(count <= SMALL) & (index - begin + step < count)]
            left.append(one)
            right.append(one + step)
        crowded = np.flatnonzero(count > SMALL)
        pivot = np.empty(0, np.int64)
        if len(crowded):
            order = crowded[np.lexsort((base.mixed(sig[crowded].view(np.uint64)), node[crowded]))]
            pivots = order[np.r_[True, node[order][1:] != node[order][:-1]]]
            pivot = np.repeat(pivots, counts[counts > SMALL])
            left.append(pivot[pivot != crowded])
            right.append(crowded[pivot != crowded])
        left, right = np.concatenate(left), np.concatenate(right)
        keep = may_link(size[left], bits[left], size[right], bits[right], percent)
        return _found((sig[left[keep]], sig[right[keep]]), (node[crowded], sig[pivot], sig[crowded], size[crowded]))

    return entries.groupBy("bucket").applyInPandas(in_bucket, FOUND_SCHEMA)


def _overlaps(x, others):
    """Members that the sorted set x shares with each of the other sorted sets."""
    joined = np.concatenate(others)
    at = np.searchsorted(x, joined)
    at[at == len(x)] = 0
    edges = np.cumsum([0] + [len(o) for o in others[:-1]])
    return np.add.reduceat((x[at] == joined).astype(np.int64), edges)


def settle(label, sketches, grams, side, percent):
    """Pairs of places that link, enough of them to join all groups that links between these sets join.

    `label` tells groups known before; sets of one group are not compared. `side` is None, or tells two blocks apart, of
    which only sets on different sides are compared. Small groups go first; a set meets the sets of other groups in falling
    order of agreeing sketch tokens, until its group is joined with theirs or they are all refused.
    """
    names, own = np.unique(label, return_inverse=True)
    size = np.array([len(g) for g in grams])
    group, members = np.arange(len(names)), np.bincount(own)
    least = least_agreement(COORDINATES, percent / 100, TOKEN_DEVIATIONS)
    open_to = np.ones(len(names), bool)
    links = []
    for first in np.argsort(members, kind="stable"):
        # All pairs with sets of a group that had its turn are decided.
        open_to[first] = False
        for u in np.flatnonzero(own == first):
            others = np.flatnonzero(open_to[own] & (group[own] != group[first]))
            if side is not None:
                others = others[side[others] != side[u]]
            near = 100 * np.minimum(size[others], size[u]) >= percent * np.maximum(size[others], size[u])
            others = others[near]
            agree = (sketches[others] == sketches[u]).sum(axis=1)
            others = others[agree >= least][np.argsort(-agree[agree >= least], kind="stable")]
            while len(others):
                some, others = others[:AT_ONCE], others[AT_ONCE:]
                both = _overlaps(grams[u], [grams[v] for v in some])
                for v in some[100 * both >= percent * (size[u] + size[some] - both)]:
                    if group[own[v]] != group[first]:
                        links.append((u, v))
                        group[group == group[own[v]]] = group[first]
                others = others[group[own[others]] != group[first]]
    return links


def settled(units, grams, percent):
    """Links (a, b) between sets of different groups within units.

    `units` has unit, sig, size, label and side (null, or the block a set stands in); `grams` (sign, grams) gives their sets.
    Sketches are made again of the sets, which takes less than bringing the two together.
    """
    total = units.agg(F.sum("size")).first()[0] or 0
    buckets = max(BUCKETS_AT_LEAST, int(total // BUCKET_GRAMS))
    rows = units.join(grams, units["sig"] == grams["sign"]).select("unit", "sig", "label", "side", "grams")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("unit"), F.lit(buckets)))

    def in_bucket(rows):
        found = []
        for _, unit in rows.groupby("unit", sort=False):
            unit = unit.sort_values("sig")
            sig = unit["sig"].to_numpy()
            sets = [np.frombuffer(g, np.uint64) for g in unit["grams"]]
            sketches = np.array([sketch(g) for g in sets])
            side = None if unit["side"].isna().any() else unit["side"].to_numpy()
            pairs = settle(unit["label"].to_numpy(), sketches, sets, side, percent)
            found += [(min(sig[u], sig[v]), max(sig[u], sig[v])) for u, v in pairs]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return rows.groupBy("bucket").applyInPandas(in_bucket, LINK_SCHEMA).distinct()


def units_of(opened):
    """Units of open nodes: all sets of nodes of one pivot, each once; above LIMIT sets, every two blocks of them."""
    rows = opened.groupBy(F.col("pivot"), "sig").agg(F.max("size").alias("size"), F.max("label").alias("label"))
    counts = rows.groupBy("pivot").agg(F.ceil(F.count("*") / F.lit(LIMIT)).cast("int").alias("blocks"))
    rows = base.stored(rows.join(counts, "pivot"), "units")
    small = rows.where("blocks = 1").select(F.xxhash64("pivot").alias("unit"), "sig", "size", "label", F.lit(None).cast("int").alias("side"))
    large = rows.where("blocks > 1").withColumn("own", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.xxhash64("pivot", F.least("own", "other"), F.greatest("own", "other"))
    # A block against itself has no sides.
    side = F.when(F.col("own") != F.col("other"), (F.col("own") > F.col("other")).cast("int"))
    return small.union(large.select(unit, "sig", "size", "label", side))


def confirmed(sets, pairs, percent):
    """The candidate pairs whose full sets are similar enough."""

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    left = sets.select(F.col("sign").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("sign").alias("b"), F.col("grams").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(check, "a long, b long")


def open_members(members, labels):
    """Members of nodes that hold sets of several groups, with label and the number of members of the node."""
    own = members.join(labels, members["sig"] == labels["node_id"], "left").select(
        *members.columns, F.coalesce("label", "sig").alias("label")
    )
    own = base.stored(own, "members")
    nodes = own.groupBy("node").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members"))
    nodes = base.stored(nodes.where("low <> high").select("node", "members"), "nodes")
    return base.stored(own.join(nodes, "node"), "open")


def links(docs, sets, width=WIDTH, percent=PERCENT, recall=RECALL):
    """(node_id, label) of every set that links with another: the smallest signature of its group."""
    trees = trees_for(recall, percent)
    known = sets.where("signature is not null")

    def buckets_for(n):
        return max(BUCKETS_AT_LEAST, n // BUCKET_ENTRIES)

    def labelled(found):
        return base.stored(connected(found).select(F.col("node").alias("node_id"), "label"), "labels")

    def as_links(labels):
        return labels.select(F.col("node_id").alias("a"), F.col("label").alias("b"))

    entries = path_entries(known.select("signature", "n_shingles", "sketch"), True, LEVELS, buckets_for(known.count() * trees * FAN**LEVELS), trees)
    found = base.stored(met(entries, percent), "found")
    pairs = base.stored(found.where("node is null").select("a", "b").distinct(), "pairs")
    members = found.where("node is not null").select("node", "pivot", "sig", "size")
    # One more scan gives all sets that any later turn looks at.
    named = pairs.select(F.col("a").alias("sign")).union(pairs.select("b")).union(members.select("sig")).distinct()
    grams = stored_sets(docs, sets, named, width)
    labels = labelled(confirmed(grams, pairs, percent))
    for turn in range(ROUNDS + 1):
        opened = open_members(members, labels)
        later = opened.where(F.col("members") > LIMIT)
        more = turn < ROUNDS and not later.isEmpty()
        now = opened.where(F.col("members") <= LIMIT) if more else opened
        new = base.stored(settled(base.stored(units_of(now), "units"), grams, percent), "links")
        if more:
            sketches = known.select("signature", "n_shingles", "sketch").join(
                later.select(F.col("sig").alias("signature")).distinct(), "signature", "left_semi"
            ).dropDuplicates(["signature"])
            going = later.select(F.col("sig").alias("signature"), "node").join(sketches, "signature")
            entries = path_entries(going, False, DEEPER, buckets_for(later.count() * FAN**DEEPER), trees)
            found = base.stored(met(entries, percent), "found")
            members = found.where("node is not null").select("node", "pivot", "sig", "size")
            pairs = base.stored(found.where("node is null").select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
            new = base.stored(new.union(confirmed(grams, pairs, percent)), "links")
        if not new.isEmpty():
            # Labels are links too, and give the same groups as the links they came from.
            labels = labelled(new.union(as_links(labels)))
        if not more:
            return labels


def near_duplicates(docs, width=WIDTH, percent=PERCENT, recall=RECALL):
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable over links, its own included),
    kept (whether that is its own).

    Documents link when 100 * shared n-grams >= percent * all n-grams of both; every link is confirmed on the full sets, and
    a pair just at the threshold is found with probability `recall` at least, a closer one more surely. `docs` needs doc_id
    and text, other columns are not read. A null text and a text without words have the empty set, which links with nothing.
    Repeated rows and copies are one set; all rows of the smallest id are kept. A null doc_id does not count as smallest; a
    group of null ids only has a null component_id and is kept. An empty table gives an empty result.
    """
    base.ship(docs.sparkSession)
    sets = base.stored(scan_sets(docs, width), "sets")
    labels = links(docs, sets, width, percent, recall)
    # Copies collapse to their signature before any join.
    copies = sets.where("signature is not null").groupBy("signature").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    copies = copies.join(labels, copies["signature"] == labels["node_id"], "left").select(
        "signature", "low", "n", F.coalesce("label", "signature").alias("label")
    )
    copies = base.stored(copies, "copies")
    groups = copies.groupBy("label").agg(F.min("low").alias("component"), F.sum("n").alias("all"))
    groups = groups.where(F.col("all") > 1).select("label", "component")
    changed = base.stored(copies.join(groups, "label").select(F.col("signature").alias("sign"), "component"), "groups")
    own = sets.select("doc_id", "n_shingles", "signature")
    # Both sides come straight from tables, so that adaptive execution can split a signature with very many copies.
    out = own.join(changed, own["signature"] == changed["sign"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
