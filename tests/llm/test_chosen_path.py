"""The chosen-path join against all pairs, on crowded nodes and hard cases."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import base, chosen_path

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, signature string, node int, label double, kept string"


def brute_sets(text, width=2):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + width]) for i in range(len(own) - width + 1)) if len(own) >= width else frozenset([tuple(own)])


def brute(rows, percent=80):
    sets = [brute_sets(t) for _, t in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and group[a] != group[b] and 100 * both >= percent * len(sets[a] | sets[b]):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    low = {g: min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in set(group)}
    return Counter((i, len(s), low[g], i == low[g]) for (i, _), s, g in zip(rows, sets, group))


def found(spark, rows, **settings):
    df = spark.createDataFrame([(i, t, "s", 1, 0.5, "k") for i, t in rows], SCHEMA).repartition(4)
    out = chosen_path.near_duplicates(df, **settings)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return Counter(tuple(r) for r in out.collect())


def varied(rng, words, edits, tag):
    own = list(words)
    for at in rng.sample(range(len(own)), edits):
        own[at] = f"{tag}_{at}"
    return " ".join(own)


def test_hard_cases(spark):
    rng = random.Random(4)
    body = [f"w{rng.randrange(300)}" for _ in range(90)]
    long = " ".join(f"v{rng.randrange(5000)}" for _ in range(20_000))
    rows = [(i, varied(rng, body, e, i)) for i, e in enumerate([0, 0, 1, 2, 4, 9, 30])]
    rows += [(20, None), (21, ""), (22, " \n\t "), (23, "one"), (24, "ONE"), (25, "one two"), (26, "One  two"), (27, "zz " * 50)]
    rows += [(28, "zz zz"), (None, " ".join(body)), (None, "alone here"), (None, "alone here"), (1, rows[1][1]), (29, long), (30, long + " end")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == Counter()


@pytest.mark.parametrize("limit, rounds", [(2048, 3), (16, 2), (16, 0)])
def test_crowded_nodes_lose_no_group(spark, monkeypatch, limit, rounds):
    """Three families of near copies, close to each other but apart, are larger than a node's limit."""
    monkeypatch.setattr(chosen_path, "LIMIT", limit)
    monkeypatch.setattr(chosen_path, "ROUNDS", rounds)
    rng = random.Random(6)
    body = [f"m{i}" for i in range(100)]
    families = [varied(rng, body, 9, f"f{k}").split() for k in range(3)]
    rows = [(i, varied(rng, families[i % 3], rng.choice([0, 1, 2, 3]), i)) for i in range(120)]
    assert found(spark, rows) == brute(rows)


def test_recall_at_the_threshold_meets_the_target():
    """Pairs of sets with exactly the least similarity share a node of the first turn."""
    rng = np.random.default_rng(7)
    trees = chosen_path.trees_for(0.9999, 80)
    roots = base.mixed(np.arange(1, trees + 1, dtype=np.uint64))
    hits, agreeing, pairs = 0, 0, 400
    for _ in range(pairs):
        both, x, y = (np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (320, 40, 40))
        sketches = np.array([chosen_path.sketch(np.sort(np.r_[both, own])) for own in (x, y)])
        shared = [np.intersect1d(*[chosen_path.branched(np.array([r]), sketches[k : k + 1], 3) for k in (0, 1)]).size for r in roots]
        hits += any(shared)
        bits = chosen_path.first_bits(sketches)
        agreeing += bool(chosen_path.may_link(360, bits[0], 360, bits[1], 80))
    assert hits >= pairs - 1 and agreeing == pairs


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(8)
    both = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    estimates = []
    for _ in range(30):
        x, y = (np.sort(np.r_[both, rng.integers(0, 1 << 63, 1000).astype(np.uint64)]) for _ in range(2))
        estimates.append(np.mean(chosen_path.sketch(x) == chosen_path.sketch(y)))
    assert abs(np.mean(estimates) - 0.6) < 0.04


@pytest.mark.parametrize("sides", [False, True])
def test_settling_joins_what_links_join(sides):
    rng = np.random.default_rng(10)
    body = np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64))
    grams = []
    for _ in range(60):
        kept = rng.choice(body, rng.integers(len(body) - 40, len(body)), replace=False)
        grams.append(np.unique(np.r_[kept, rng.integers(0, 1 << 63, rng.integers(0, 25)).astype(np.uint64)]))
    sketches = np.array([chosen_path.sketch(g) for g in grams])
    label = np.where(np.arange(60) % 5 == 0, 7, np.arange(60) + 100)
    side = np.arange(60) % 2 if sides else None

    def groups(pairs):
        group = list(label)
        for a, b in pairs:
            group = [group[a] if g == group[b] else g for g in group]
        return {frozenset(np.flatnonzero(np.array(group) == g).tolist()) for g in set(group)}

    every = [
        (a, b) for a, b in itertools.combinations(range(60), 2)
        if (side is None or side[a] != side[b])
        and 100 * len(np.intersect1d(grams[a], grams[b])) >= 80 * len(np.union1d(grams[a], grams[b]))
    ]
    got = chosen_path.settle(label, sketches, grams, side, 80)
    assert {tuple(sorted(map(int, p))) for p in got} <= set(every) and groups(got) == groups(every)


def test_blocks_hold_every_entry_once():
    rng = np.random.default_rng(9)
    node, sig = rng.integers(0, 50, 500).astype(np.uint64), rng.integers(0, 20, 500).astype(np.int64)
    blocks = chosen_path._blocks((node, sig, sig.view(np.uint64), np.full(500, 7)), 8)
    got = chosen_path._entries(blocks["entries"])
    assert sorted(zip(got[0], got[1])) == sorted(set(zip(node, sig)))
    assert (got[2].view(np.int64) == got[1]).all() and (got[3] == 7).all()


def test_pairs_of_one_large_group_stay_linear(spark):
    rng = random.Random(11)
    body = [f"m{i}" for i in range(200)]
    rows = [(i, varied(rng, body, 1, i)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = base.stored(chosen_path.scan_sets(df), "sets").select("signature", "n_shingles", "sketch")
    entries = chosen_path.path_entries(sets, True, chosen_path.LEVELS, 64, 4)
    pairs = chosen_path.met(entries, 80).where("node is null").select("a", "b").distinct()
    assert pairs.count() < 10 * len(rows)
    assert pairs.where(F.col("a") >= F.col("b")).count() == 0


def test_registered_query_equals_sql(spark):
    from tallyhouse.llm import queries
    from workload.compare import connect, differences

    name = "op13_minhash_near_dedup"
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE_SQL[name]) == []


def test_units_are_settled_from_the_sets_alone(spark):
    sets = [np.arange(i, i + 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in (0, 5, 1000)]
    grams = spark.createDataFrame([(i, bytearray(np.sort(g).tobytes())) for i, g in enumerate(sets)], "sign long, grams binary")
    units = spark.createDataFrame([(7, i, 200, i, None) for i in range(3)], "unit long, sig long, size long, label long, side int")
    assert [tuple(r) for r in chosen_path.settled(units, grams, 80).collect()] == [(0, 1)]
