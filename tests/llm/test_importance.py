"""Importance resampling against brute force, brackets against sorting, and hard cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import importance

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, score string, rank int, weight double, key int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, target, runs=1, buckets=10_000, least=20, percent=10):
    def features(text):
        own = words(text)
        return [zlib.crc32(" ".join(own[i : i + n]).encode()) % buckets for n in range(1, runs + 1) for i in range(len(own) - n + 1)]

    s = collections.Counter(b for _, t in docs for b in features(t))
    t = collections.Counter(b for text in target for b in features(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text in docs:
        own = features(text)
        weight = sum(map(gain, own)) // len(own) if own else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(own), weight, score, None])
    able = [r for r, (_, text) in zip(out, docs) if r[3] is not None and len(words(text)) >= least]
    able.sort(key=lambda r: (-r[3], r[0], r[1], r[2]))
    for place, row in enumerate(able[: percent * len(able) // 100]):
        row[4] = place + 1
    return collections.Counter(map(tuple, out))


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "s", 1, 0.5, 2) for i, t in docs], SCHEMA).repartition(4)


def hard_documents():
    rng = random.Random(8)
    vocabulary = [f"wort{i}" for i in range(50)] + ["Élan", "日本", "x_y", "A1b2"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(5, 60)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " \n\t "), (303, "!!! ---"), (304, "a" * 5000), (None, docs[0][1]), (None, None)]
    docs += [(305, " ".join(rng.choices(vocabulary, k=30_000)))]
    return docs + [docs[5]] * 70 + [(6, docs[9][1])] * 3


def collected(df):
    return collections.Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("runs, buckets, percent", [(1, 10_000, 10), (2, 97, 35), (1, 10_000, 100), (1, 10, 0)])
def test_resampling_equals_brute_force(spark, runs, buckets, percent):
    docs, target = hard_documents(), ["wort1 wort2 wort3 ÉLAN", None, "", "WORT1 x-y"]
    rows = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resampled(frame(spark, docs), rows, runs=runs, buckets=buckets, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert collected(got) == brute(docs, target, runs, buckets, percent=percent)


def test_bracket_is_widened_until_it_holds_the_cutoff(spark, monkeypatch):
    values = [random.Random(2).randrange(400) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "score long").repartition(5)
    order = sorted(values, reverse=True)
    asked = []

    def wrong(rows, column, shares):
        asked.append(shares)
        return [v + 150 for v in np.quantile(values, shares, method="lower").tolist()]

    for sketch in (importance.sketched_quantiles, wrong):
        monkeypatch.setattr(importance, "sketched_quantiles", sketch)
        for wanted in (1, 7, 300, 1500, 2999, 3000):
            low, high, above = importance.bracket(df, "score", wanted, len(values))
            assert low is None or low <= order[wanted - 1]
            assert high is None or order[wanted - 1] <= high or above == wanted
            assert above == sum(high is not None and v > high for v in values) <= wanted
    assert len(asked) > 6


def test_numbering_is_one_order_over_all_parts(spark):
    values = [random.Random(3).randrange(40) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, score long").repartition(7)
    got = importance.numbered(df, [F.desc("score"), F.asc("doc_id")]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 501))
    assert [(r.score, r.doc_id) for r in got] == sorted(((v, i) for i, v in enumerate(values)), key=lambda r: (-r[0], r[1]))


def test_empty_tables(spark):
    texts = spark.createDataFrame([("wort1 wort2",)], "text string")
    empty = spark.createDataFrame([], SCHEMA)
    assert importance.resampled(empty, texts).count() == 0
    docs = hard_documents()[:40]
    assert collected(importance.resampled(frame(spark, docs), texts.limit(0))) == brute(docs, [])


def test_registered_query_equals_sql(spark):
    from tallyhouse.llm import queries
    from workload.compare import connect, differences

    name = "op12_importance_resampling"
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE_SQL[name]) == []
