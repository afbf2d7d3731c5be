"""The training-data operators against brute force, on hard cases and on the small tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyhouse.llm import (
    base, byte_bpe, components, decontamination, html_text, language_id, ngram_join, quality_cnn, quality_rules,
    queries, substring_dedup, token_shards, tokens, toxicity, wavelet,
)
from tallyhouse.llm.tokens import load_ranks

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(60)]


def words(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


BASE = words(80)
EDGES = [
    (1, " ".join(BASE), "en"), (2, " ".join(BASE), "en"), (2, " ".join(BASE), "en"), (3, " ".join([*BASE[:40], "x", *BASE[40:]]), "en"),
    (4, None, "en"), (5, "", None), (6, " \n\t ", "de"), (7, "one two", "de"), (8, "ONE Two", "de"), (9, " ".join(words(3000)), "fr"),
    (None, " ".join(BASE), "en"), (10, "zz " * 120, "es"), (11, "don't stop é\x00 日本 a b", "es"), (12, " ".join(words(40) + BASE[:36]), "en"),
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, lang, "s", 0 if t is None else len(t), "extra", 1.0, "x") for i, t, lang in EDGES]
    return spark.createDataFrame(rows, SCHEMA + ", marks string, score double, key string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def brute_sets(text):
    own = split("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not own:
        return set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)}


def brute_components(rows):
    sets = [(i, brute_sets(t)) for i, t in rows]
    group = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    low = {g: min((sets[k][0] for k in range(len(sets)) if group[k] == g and sets[k][0] is not None), default=None) for g in group}
    return Counter((i, len(s), low[g]) for (i, s), g in zip(sets, group))


def test_near_duplicate_groups(edges, empty):
    got = Counter(tuple(r)[:3] for r in ngram_join.near_duplicate_groups(edges).collect())
    assert got == brute_components([(i, t) for i, t, _ in EDGES])
    assert ngram_join.near_duplicate_groups(empty).count() == 0


def test_crowded_ngrams_lose_no_link(spark):
    rng = random.Random(9)
    middle = [f"m{i}" for i in range(60)]
    rows = []
    for i in range(60):
        own = list(middle)
        for at in rng.sample(range(60), rng.choice([0, 1, 1, 2, 2, 3])):
            own[at] = f"e{i}_{at}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(tuple(r)[:3] for r in ngram_join.near_duplicate_groups(docs).collect())
    assert got == brute_components(rows)


def test_filters_never_reject_a_link():
    rng = np.random.default_rng(3)
    for _ in range(300):
        x = np.unique(rng.integers(0, 60, 40).astype(np.uint64))
        y = np.unique(np.concatenate([rng.choice(x, len(x) - 3), rng.integers(0, 60, 4).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        assert ngram_join.linked(x, y) == (100 * both >= 75 * (len(x) + len(y) - both))
        apart = int(np.bitwise_count((ngram_join.parity_marks(x) ^ ngram_join.parity_marks(y)).view(np.uint64)).sum())
        assert apart <= len(x) + len(y) - 2 * both


def test_one_per_group(edges):
    kept = ngram_join.one_per_group(edges)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7, 9, 10, 11, 12]


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8), (7, 7), (None, 1)], "a long, b long")
    assert {tuple(r) for r in components.connected(links).collect()} == {(2, 2), (3, 2), (4, 2), (5, 2), (8, 8), (9, 8)}


def brute_removal(rows, width=35):
    own = [split(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in own for i in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, own):
        gone = {k for at in range(len(w) - width + 1) if seen[tuple(w[at : at + width])] > 1 for k in range(at, at + width)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return Counter(out)


def test_substring_dedup(edges, empty):
    got = Counter(tuple(r) for r in substring_dedup.removal_report(edges).collect())
    assert got == brute_removal([(i, t) for i, t, _ in EDGES])
    cleaned = substring_dedup.without_repeats(edges)
    assert cleaned.columns == edges.columns and cleaned.count() == len(EDGES)
    assert {r.text for r in cleaned.where("doc_id = 4 or doc_id = 11").collect()} == {None, EDGES[12][1]}
    assert substring_dedup.removal_report(empty).count() == 0


def test_spans_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(substring_dedup, "SPAN", 100)
    hashes = np.arange(400, dtype=np.uint64)
    seen = [o + i for o, s in substring_dedup.spans(hashes) for i in range(len(s) - 34)]
    assert sorted(seen) == list(range(366))


def test_byte_bpe_equals_library_and_round_trips(edges, empty, spark):
    ranks = load_ranks(queries.RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = Counter(tuple(r) for r in byte_bpe.round_trip(edges, queries.RANKS, public_tokenizers.PATTERN).collect())
    want = Counter()
    for i, t, _ in EDGES:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert got == want
    assert byte_bpe.round_trip(empty, queries.RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_appends_and_edits():
    own, _ = byte_bpe.vocabulary(queries.RANKS, public_tokenizers.PATTERN)
    piece = byte_bpe.Prefixes(own, b" inter")
    piece.append(b"nationalisation")
    assert piece.tokens() == own.encode_piece(b" internationalisation")
    rng, text = random.Random(1), byte_bpe.Encoded(own, "hello there world, don't stop  now")
    for _ in range(200):
        start = rng.randint(0, len(text.text))
        stop = min(len(text.text), start + rng.randint(0, 5))
        text.replace(start, stop, "".join(rng.choice(" \n.,'slteda1é") for _ in range(rng.randint(0, 6))))
        assert text.tokens() == own.encode(text.text) and own.decode(text.tokens()).decode() == text.text


def test_remembered_parts_do_not_change_ids():
    asked = []
    memory = tokens.Remembering(lambda part: asked.append(part) or [ord(c) for c in part], 16 * tokens.ENTRY_BYTES)
    rng = random.Random(3)
    for _ in range(300):
        text = " ".join(["often", *rng.choices("abcdefghijklmnop", k=rng.randint(0, 4))]) if rng.random() < 0.9 else ""
        assert memory.ids(text).tolist() == [ord(c) for c in text]
        assert len(memory) <= 8 and len(memory.old) <= 8
    assert asked.count("often") == 1


def test_memory_is_bounded_in_bytes_whatever_the_parts():
    """Unspaced texts are one part each: they are encoded but not kept."""
    memory = tokens.Remembering(lambda part: [ord(c) for c in part], 40_000)
    rng = random.Random(4)
    for n in range(400):
        text = "".join(rng.choice("日本語テキスト") for _ in range(rng.choice([3, 200, 5000])))
        assert memory.ids(text).tolist() == [ord(c) for c in text]
        for generation in (memory, memory.old):
            kept = sum(tokens.ENTRY_BYTES + len(part) + len(ids) for part, ids in generation.items())
            assert kept <= 20_000 and all(len(part) <= tokens.LONGEST_PART for part in generation)


def test_pairs_are_bounded_and_give_the_same_tokens():
    ranks = load_ranks(queries.RANKS)
    small = byte_bpe.Vocabulary(ranks, public_tokenizers.PATTERN, most_pairs=50)
    large, _ = byte_bpe.vocabulary(queries.RANKS, public_tokenizers.PATTERN)
    rng = random.Random(6)
    for _ in range(200):
        text = "".join(rng.choice("abcdeé日 ñ'12\n") for _ in range(40))
        assert small.encode(text) == large.encode(text)
        assert len(small.fitting) + len(small.fitting.old) <= 51


def test_tokens_of_documents(edges, empty):
    got = byte_bpe.with_tokens(edges, queries.RANKS, public_tokenizers.PATTERN)
    assert got.columns == [*[c for c in edges.columns if c != "text"], "n_tokens", "token_ids", "round_trip"]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(queries.RANKS), special_tokens={})
    want = Counter((i, tuple(library.encode_ordinary(t or ""))) for i, t, _ in EDGES)
    rows = got.collect()
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in rows) == want
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) and r.marks == "extra" for r in rows)
    assert byte_bpe.with_tokens(empty, queries.RANKS, public_tokenizers.PATTERN).count() == 0


def test_pairs_merge_by_rank():
    ranks = load_ranks(queries.RANKS)
    library = tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("aeinrst é\n0") for _ in range(rng.randint(1, 14)))
        whole = ranks.get(text.encode())
        merged = byte_bpe.merged_by_rank(text.encode(), ranks)
        assert (merged if whole is None else [whole]) == library.encode_ordinary(text)


def test_wavelet_matrix():
    values = np.random.default_rng(2).integers(0, 300, 3000).astype(np.uint16)
    matrix, ids, ends = wavelet.from_file(wavelet.to_file(values, 9, [7, None], [1000, 3000]))
    assert (matrix.values() == values).all() and ids == [7, None] and list(ends) == [1000, 3000]
    assert all(matrix.access(i) == values[i] for i in range(0, 3000, 97))
    for value in (0, 17, 299, 511, 9999):
        places = np.flatnonzero(values == value).tolist()
        assert matrix.occurrences(value) == places and matrix.count(value, 500, 2500) == sum(500 <= p < 2500 for p in places)


ADDED = [(50, "a <|endoftext|> b", "en"), (51, "<|endoftext|>", "en"), (52, "no<|endoftext|>\n\n<|endoftext|> gap", "de")]


def test_token_shards(edges, empty, spark):
    library = Tokenizer.from_file(queries.TOKENIZER)
    added = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in ADDED], SCHEMA)
    docs = edges.where("doc_id is not null").dropDuplicates(["doc_id"]).select(*added.columns).union(added)
    got = {r.doc_id: tuple(r)[1:] for r in token_shards.token_report(docs, queries.TOKENIZER).collect()}
    start = 0
    for i, t in sorted({(i, t) for i, t, _ in EDGES + ADDED if i is not None}):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_shards.token_report(edges, queries.TOKENIZER).count() == len(EDGES)
    assert token_shards.token_report(empty, queries.TOKENIZER).count() == 0


def test_language_id(edges, empty, spark):
    held_out = base.crc_remainder("doc_id", 5) == 0
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = queries.op1_language_id(spark, SF_DIR).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert rows.where("lang = lang_pred").count() >= 0.95 * rows.count()
    model = language_id.learn(docs)
    assert {r.lang_pred for r in language_id.predict(edges, model, held_out).where("doc_id in (4, 5, 6)").collect()} == {"und"}
    assert language_id.predict(empty, language_id.learn(empty), held_out).count() == 0
    assert {r.lang_pred for r in language_id.predict(edges, language_id.learn(edges.where("lang = 'en'")), held_out).collect()} == {"en", "und"}
    for n in (3, 4, 12):
        code = language_id.codewords(n)
        assert min((code[a] != code[b]).sum() for a, b in itertools.combinations(range(n), 2)) >= 2


def test_quality_network(edges, empty, spark):
    good, bad = [" ".join(words(30)) for _ in range(40)], ["$$$ ### " * 20 for _ in range(40)]
    model = quality_cnn.train([*good, *bad], [1] * 40 + [0] * 40, epochs=4)
    assert quality_cnn.probability(" ".join(words(40)), model) > 0.8 > 0.2 > quality_cnn.probability("### $$$ " * 15, model)
    long = quality_cnn._bytes("### $$$ " * 40_000)
    whole = np.maximum(quality_cnn.responses(long, model), 0).max(axis=0)
    assert np.allclose(quality_cnn.features(long, model)[quality_cnn.FILTERS :], whole, atol=1e-4)
    held_out = base.crc_remainder("doc_id", 4) == 2
    report = quality_cnn.quality_report(edges, model, held_out).collect()
    assert len(report) == len(EDGES) and all(0 <= r.score <= 1 for r in report)
    none = quality_cnn.learn(empty, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality_cnn.quality_report(edges, none, held_out).collect()} == {0.5}
    assert quality_cnn.good_documents(edges, none).columns == edges.columns


def test_toxicity_index_is_exact_and_learns(edges, empty, spark):
    rng = np.random.default_rng(4)
    idf = np.ones(30)
    vectors = [toxicity.vector({int(p): 1 for p in rng.choice(30, 4)}, idf) for _ in range(200)]
    index = toxicity.BlockMaxIndex(vectors, 30)
    dense = np.zeros((200, 30))
    for i, (p, w) in enumerate(vectors):
        dense[i, p] = w
    for p, w in vectors[:40]:
        near, similar = index.nearest(p, w, 7)
        score = dense[:, p] @ w
        order = np.lexsort((np.arange(200), -score.round(12)))[:7]
        assert np.allclose(similar, score[order]) and np.allclose(np.sort(score[near]), np.sort(score[order]))
    rows = [(i, " ".join(words(20) + (["vile"] if i % 2 else []))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")))
    held_out = base.crc_remainder("doc_id", 5) == 0
    assert all(r.predicted == r.doc_id % 2 for r in toxicity.toxicity_report(docs, model, held_out).collect())
    assert toxicity.toxicity_report(edges, model, held_out).count() == len(EDGES)
    none = toxicity.learn(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.toxicity_report(edges, none, held_out).collect()} == {0.5}


def test_toxicity_searches_every_text_over_all_terms(spark):
    rows = [(i, " ".join(words(20))) for i in range(30)] + [(100 + i, f"vile{'abcd'[i]} brute oaf " + " ".join(words(8))) for i in range(4)]
    probes = [(200, "brute oaf " + " ".join(words(8))), (201, " ".join(words(20))), (202, "vilea"), (203, "vilea nothing like it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, docs.select("doc_id", (F.col("doc_id") >= 100).cast("int").alias("toxic")))
    got = {r.doc_id: r for r in toxicity.toxicity_report(spark.createDataFrame(probes, docs.schema), model, F.lit(True)).collect()}
    assert set(got[200].nearest) < {100, 101, 102, 103} and got[200].predicted == 1 and got[201].predicted == 0
    # One word of one example is enough to be found by it; words of no example lengthen the vector.
    assert list(got[202].nearest) == list(got[203].nearest) == [100]
    assert got[203].similarities[0] < 0.7 * got[202].similarities[0]
    rng = np.random.default_rng(8)
    vectors = [toxicity.vector({int(p): int(p) % 3 + 1 for p in rng.choice(40, 12, replace=False)}, np.ones(60)) for _ in range(300)]
    index = toxicity.BlockMaxIndex(vectors, 40)
    assert index.dense.shape[1] == 40
    dense = np.zeros((300, 60))
    for i, (p, w) in enumerate(vectors):
        dense[i, p] = w
    for i, (p, w) in enumerate(vectors[:40]):
        score = np.delete(dense, i, 0)[:, p] @ w
        near, similar = index.nearest(np.append(p, 50), np.append(w, 1.0), 9, but=i)
        assert i not in near and np.allclose(similar, -np.sort(-score)[:9])


PAGE = (
    "<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><a href=x>Home</a></nav>"
    "<div class='ad'>Buy the thing now.</div><article><h1>A &amp; B</h1><p>First\n  block <b>bold</b>.<br><p>Second &lt;x&gt;</p>"
    "<div class=\"comments\"><p>I like it</p></div><aside>See also</aside></article><footer>&copy; all</footer>"
)


def test_html_text(spark):
    assert html_text.main_text(PAGE) == "A & B\nFirst block bold.\nSecond <x>"
    prose = "This is a text of the kind that one would find in the middle of a page, and it is about as long as it has to be. " * 3
    page = f"<body><ul><li><a href=1>One</a><li><a href=2>Two</a></ul><p>{prose}</p><p>Short one.</p><p>{prose}</p><form>Name</form>"
    assert html_text.main_text(page) == f"{prose.strip()}\nShort one.\n{prose.strip()}"
    for broken in ("", "<", "<p", "<!-- open", "<script>x", "</div></p>", "a < b", "<article>" * 50):
        assert isinstance(html_text.main_text(broken), str)
    pages = spark.createDataFrame([(1, "u", PAGE), (None, None, None), (2, "u", "")], "page_id long, url string, html string")
    assert {(r.page_id, r.n_chars) for r in html_text.extracted(pages).collect()} == {(1, len(html_text.main_text(PAGE))), (None, 0), (2, 0)}
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_html_markup_is_evidence_only():
    prose = "This is a text of the kind that one would find in the middle of a page, and it is about as long as it has to be. " * 3
    own, links = prose.strip(), "<ul><li><a href=1>Next one</a><li><a href=2>And the one after it</a></ul>"
    # A teaser beside a body in div, one wrapper with a telling class, a form around a page, a link list in the article.
    teaser = f"<div><p>{prose}</p><p>{prose}</p></div><article class=card><a href=x>Other story</a></article>"
    assert html_text.main_text(teaser) == f"{own}\n{own}"
    assert html_text.main_text(f"<div class='page sidebar'><nav>{links}</nav><article><p>{prose}</p></article></div>") == own
    assert html_text.main_text(f"<form id=search><div>{links}<p>{prose}</p></div></form><footer>All is ours</footer>") == own
    assert html_text.main_text(f"<article><h1>Head</h1><p>{prose}</p>{links}</article>") == f"Head\n{own}"
    comments = "<div class=comments><article><p>I am of another mind.</p></article></div>"
    assert html_text.main_text(f"<article><p>{prose}</p></article>{comments}") == own
    assert html_text.main_text(f"<main><p>{prose}</p></main><div><p>{prose}</p></div><div>Short.</div>") == f"{own}\n{own}"


def brute_rules(text):
    own, text = split(text), text or ""
    runs = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    seen = Counter(runs)
    covered = {k for i, r in enumerate(runs) if seen[r] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if split(x)]
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(edges, empty, spark):
    trusted = edges.where("doc_id = 1").select("doc_id")
    got = Counter((r.doc_id, *tuple(r)[1:6]) for r in quality_rules.quality_rules(edges, trusted).collect())
    assert got == Counter((i, *brute_rules(t)) for i, t, _ in EDGES)
    assert quality_rules.quality_rules(empty, trusted).count() == 0
    none = quality_rules.quality_rules(edges, trusted.limit(0))
    assert all(r.kept == (not r.base_failed) for r in none.collect())
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    report = {r.doc_id: r for r in queries.op9_quality_rules(spark, SF_DIR).collect()}
    assert all(tuple(report[r.doc_id])[1:6] == brute_rules(r.text) for r in docs.collect())


def test_decontamination(spark, empty, edges):
    item = [f"q{i}" for i in range(30)]
    changed = [("zz" if k % 9 == 4 else w) for k, w in enumerate(item)]
    docs = spark.createDataFrame(
        [(1, " ".join(words(50) + item + words(50)), ""), (2, " ".join(words(30) + changed + words(9)), ""), (3, " ".join(words(200)), ""), (4, None, ""), (None, " ".join(item).upper(), "")],
        "doc_id long, text string, own_key string",
    ).repartition(2)
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "of the"), (9, None), (None, "x"), (10, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.contaminated, list(r["items"])) for r in decontamination.contamination_report(docs, bench).collect()}
    assert got == {1: (True, [7]), 2: (True, [7]), 3: (False, []), 4: (False, []), None: (True, [7])}
    kept = decontamination.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {3, 4}
    assert decontamination.contamination_report(empty, bench).count() == 0
    assert decontamination.without_contaminated(edges, bench.limit(0)).count() == len(EDGES)


def test_pipeline_keeps_columns_and_decides(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert sorted(out.columns) == sorted(docs.columns), name
        out.write.parquet(str(tmp_path / name))
        before, docs = docs.count(), spark.read.parquet(str(tmp_path / name))
        assert docs.count() <= before
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.where("not round_trip").count() == 0 and last.count() == docs.count()


def test_bounded_sample(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    sample, sizes = base.bounded_sample(rows, "y", 1000)
    found = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 18000, 1: 2000} and all(850 < n < 1150 for n in found.values())


def test_all_labelled_good_documents_are_trusted(spark):
    labels = spark.range(24_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality").union(
        spark.sql("select cast(null as bigint), 1 union all select 1L, 1")
    )
    assert quality_rules.trusted_ids(labels).count() == 12_000


def test_toxicity_looks_up_texts_together(spark):
    rng = np.random.default_rng(5)
    vectors = [toxicity.vector({int(p): int(p) % 4 + 1 for p in rng.choice(90, 9, replace=False)}, np.ones(100)) for _ in range(333)]
    index = toxicity.BlockMaxIndex(vectors, 90)
    assert 0 < index.dense.shape[1] < 90
    for (p, w), (q, x) in zip(index.vectors(30, 333), vectors[30:]):
        assert np.array_equal(p, q) and np.array_equal(w, x)
    queries_ = [*vectors[:40], (np.empty(0, np.int64), np.empty(0)), (np.array([95]), np.ones(1))]
    for i, ((p, w), (near, similar)) in enumerate(zip(queries_, index.nearest_each(queries_, 400, list(range(42))))):
        full = np.array([sum(x[q == a].sum() * b for a, b in zip(p, w)) for q, x in vectors])
        full[i] = 0
        order = [j for j in np.lexsort((np.arange(333), -full.round(12))) if full[j] > 0]
        assert near.tolist() == order and np.allclose(similar, full[order])
    for few, all_ in zip(index.nearest_each(queries_, 15), index.nearest_each(queries_, 400)):
        assert np.array_equal(few[0], all_[0][:15])
    # Terms are places by hash; the driver and the workers hold no texts of them.
    found, worth = toxicity.example_terms(spark.createDataFrame([("b\u00e9 a a", 1), ("a longer", 0)], "text string, toxic int"))
    assert found.dtype == np.uint64 and len(found) == len(worth) == 4
    own = toxicity.Terms(found)
    assert own.counts("A longer a \u4e2d") == {0: 2, 2: 1, 3: 1, 4 + toxicity.xxh3_64_intdigest("\u4e2d") % toxicity.UNSEEN: 1}


def test_texts_that_are_not_trusted_are_not_joined(spark):
    docs = spark.createDataFrame([(i % 900 if i % 7 else None, f"t{i}") for i in range(1000)], "doc_id long, text string").repartition(3)
    trusted = spark.createDataFrame([(i,) for i in [*range(0, 900, 5), 5, 10**15, None]], "doc_id long")
    flagged = quality_rules.flagged_texts(docs, trusted)
    got = {r.text: r.target for r in flagged.collect()}
    assert len(got) == 1000 and got == {r.text: int(r.doc_id is not None and r.doc_id % 5 == 0) for r in docs.collect()}
    # The filter holds back most of the others, so that they never reach the join.
    bits = base.membership_filter(trusted, "doc_id").value
    assert base.maybe_member(bits, np.arange(10**6, 10**6 + 10**5, dtype=np.uint64)).mean() < 0.01


def test_words_with_a_mark_need_no_pattern(monkeypatch):
    class Refusing:
        def findall(self, part):
            # A mark by itself is looked up once.
            assert len(part) == 1
            return [part]

    text = "Grüße, schöne wörter. Ελλάδα! (nur) das\nHaus? naïve:\n" * 2
    library = Tokenizer.from_file(queries.TOKENIZER)
    for part in ("a1 it's 'tis x's. don't!!", ". , ! a.b ab.. é. ́a, á,", "4, ²; ½. ٣!"):
        assert token_shards.tokenizer(queries.TOKENIZER).ids(part).tolist() == library.encode(part, add_special_tokens=False).ids
    monkeypatch.setattr(token_shards, "pattern", lambda source: Refusing())
    own = token_shards.Encoding(queries.TOKENIZER)
    plain = text.replace("(", "").replace("\n", " ")[:-1]
    assert own.ids(plain).tolist() == library.encode(plain, add_special_tokens=False).ids
