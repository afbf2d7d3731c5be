"""Toxicity by nearest labelled examples: exact cosine of whole TF-IDF vectors by a block-max index.

The terms are all words, and stems of words; no word is left out. Document frequencies come from all documents; a term also
counts by how much oftener toxic examples hold it than clean ones, shrunk towards 1, so that the few telling words are not
drowned by hundreds of others. Lists of rare terms are added up exactly; for common terms the index knows the largest weight
in each block of examples, and only blocks whose bound reaches the nearest so far are looked at, so the neighbours are
exact. Texts are looked up some at a time: what they need of the common terms is one product of matrices. Votes weighted by similarity are calibrated on the examples, each judged by the others. The nearest examples are
the evidence.
"""

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tallyhouse.llm import base

# Labelled rows per class that serve as examples, about: the index is as large whatever the size of the corpus.
TOXIC, CLEAN = 3000, 6000
# Cells for the document frequencies of terms that no example holds: they lengthen a vector and match nothing.
UNSEEN = 1 << 20
# Examples, dealt like the classes, that a term's counts are shrunk by.
SHRINK = 5.0
STEM = 5
BLOCK = 32
# A term is common that more than one in so many examples hold.
COMMON = 8
NEIGHBOURS = 15
EVIDENCE = 3
TOXIC_FROM = 0.5
# Words that a Python worker remembers.
REMEMBERED = 1 << 19
# Texts that are looked up at once.
AT_ONCE = 32

_WORD = re.compile(r"[^\W\d_]+")


def word_terms(word):
    """The terms of a lower-case word: itself and its stem."""
    return (word, word[:STEM] + "*") if len(word) > STEM else (word,)


def _examples(docs, labels):
    """The labelled rows that are learned from, with the sizes of the classes in all labels."""
    labels = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    few, sizes = base.bounded_sample(labels.where("toxic = 1"), "toxic", TOXIC)
    many, others = base.bounded_sample(labels.where("toxic = 0"), "toxic", CLEAN)
    # Both samples have a bound, whatever the size of the table.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(few.union(many)), "doc_id").select("doc_id", "text", "toxic")
    return base.stored(rows, "examples"), {**others, **sizes}


def example_terms(examples):
    """Hashes of all terms of the examples in order of the terms, with a worth of each: log2(1 + its rate in toxic over its
    rate in clean examples). The terms themselves stay on the executors.
    """

    def count(batches):
        found = [Counter(), Counter()]
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found[toxic].update({t for w in set(_WORD.findall(text.lower())) for t in word_terms(w)})
        terms = sorted(found[0].keys() | found[1].keys())
        yield pd.DataFrame({
            "term": pd.Series(terms, dtype=object), "hash": np.array([xxh3_64_intdigest(t) for t in terms], np.uint64).view(np.int64),
            "clean": [found[0][t] for t in terms], "toxic": [found[1][t] for t in terms],
        })

    sizes = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n0 or not n1:
        return np.empty(0, np.uint64), np.empty(0)
    rows = examples.select("text", "toxic").mapInPandas(count, "term string, hash long, clean long, toxic long")
    rows = rows.groupBy("term", "hash").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    table = rows.orderBy("term").select("hash", "clean", "toxic").toArrow()
    terms, clean, toxic = table["hash"].to_numpy().view(np.uint64), table["clean"].to_numpy(), table["toxic"].to_numpy()
    rates = [(held + SHRINK * n / (n0 + n1)) / n for held, n in ((clean, n0), (toxic, n1))]
    return terms, np.log2(1 + rates[1] / rates[0])


class Terms(dict):
    """Places of a word's terms, worked out when first asked for: in the vocabulary, or in a cell beyond it.

    The vocabulary is given by hashes of 64 bits: two arrays serve for any number of terms, where a dictionary of texts would
    take some ten times their room in every worker.
    """

    def __init__(self, hashes):
        super().__init__()
        self.order = np.argsort(hashes, kind="stable").astype(np.int32)
        self.sorted = hashes[self.order]
        self.n = len(hashes)

    def learn(self, words):
        """Make sure that the memory holds these different words; the new ones are looked up together."""
        if len(self) >= REMEMBERED:
            self.clear()
        new = [w for w in words if w not in self]
        terms = [word_terms(w) for w in new]
        values = np.array([xxh3_64_intdigest(t) for own in terms for t in own], np.uint64)
        at = np.minimum(self.sorted.searchsorted(values), self.n - 1)
        beyond = self.n + (values % np.uint64(UNSEEN)).astype(np.int64)
        places = iter(np.where(self.sorted[at] == values, self.order[at], beyond).tolist())
        for word, own in zip(new, terms):
            self[word] = tuple([next(places) for _ in own])

    def counts(self, text):
        """Term places of a text with their numbers, as a dictionary."""
        words = Counter(_WORD.findall(text.lower()))
        self.learn(words)
        out = {}
        for word, n in words.items():
            for at in self[word]:
                out[at] = out.get(at, 0) + n
        return out


def document_frequencies(docs, terms):
    """(number of documents, documents per place), over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    # The last places hold the number of documents and nothing, up to a whole number of slices.
    n_places = len(terms) + UNSEEN
    width = (n_places // base.SLICES + 1) * base.SLICES

    def count(batches):
        own = Terms(shared.value)
        table = np.zeros(width, np.int64)
        for batch in batches:
            table[n_places] += len(batch)
            for text in batch["text"]:
                if text:
                    words = set(_WORD.findall(text.lower()))
                    own.learn(words)
                    table[list(set().union(*map(own.__getitem__, words)))] += 1
        yield pd.DataFrame(list(base.slices_of(table)), columns=["slice", "cells"])

    def add(table, more):
        table += more

    table = base.merged_sketch(docs.select("text").mapInPandas(count, base.SLICE_SCHEMA), width, np.int64, add)
    return int(table[n_places]), table[:n_places]


def vector(counts, idf):
    """Unit TF-IDF vector as (places, weights), places ascending; empty without terms."""
    places, times = np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), float, len(counts))
    order = np.argsort(places)
    places = places[order]
    weights = (1 + np.log(times[order])) * idf[places]
    norm = np.sqrt((weights**2).sum())
    return (places, weights / norm) if norm else (np.empty(0, np.int64), np.empty(0))


class BlockMaxIndex:
    """Inverted lists of the examples; of common terms also the largest weight in each block of examples.

    Places from `n_terms` on are of terms that no example holds.
    """

    def __init__(self, vectors, n_terms):
        self.n = len(vectors)
        example = np.repeat(np.arange(self.n, dtype=np.int32), [len(p) for p, _ in vectors])
        place = np.concatenate([p for p, _ in vectors]) if self.n else np.empty(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if self.n else np.empty(0)
        self.begin = np.r_[0, np.cumsum(np.bincount(place, minlength=n_terms)[:n_terms])]
        order = np.argsort(place, kind="stable")
        del place
        self.example, self.weight = example[order], weight[order]
        common = np.flatnonzero(np.diff(self.begin) > max(self.n // COMMON, BLOCK))
        self.common = np.full(n_terms, -1, np.int32)
        self.common[common] = np.arange(len(common))
        self.dense = np.zeros((self.n, len(common)))
        for number, term in enumerate(common):
            part = slice(self.begin[term], self.begin[term + 1])
            self.dense[self.example[part], number] = self.weight[part]
        self.most = np.maximum.reduceat(self.dense, np.arange(0, self.n, BLOCK)) if self.n else self.dense

    def nearest(self, places, weights, k, but=-1):
        """The k examples of largest positive cosine as (examples, cosines); of equals the earlier. `but` is left out."""
        return self.nearest_each([(places, weights)], k, [but])[0]

    def nearest_each(self, queries, k, but=None):
        """`nearest` for each of some queries (places, weights)."""
        if not self.n:
            return [(np.empty(0, np.int64), np.empty(0)) for _ in queries]
        score = np.empty((len(queries), self.n))
        query = np.zeros((len(queries), self.dense.shape[1]))
        for i, (places, weights) in enumerate(queries):
            held = places < len(self.common)
            places, weights = places[held], weights[held]
            number = self.common[places]
            rare = number < 0
            query[i, number[~rare]] = weights[~rare]
            begin = self.begin[places[rare]]
            length = self.begin[places[rare] + 1] - begin
            at = np.repeat(begin - np.cumsum(length) + length, length) + np.arange(length.sum())
            score[i] = np.bincount(self.example[at], np.repeat(weights[rare], length) * self.weight[at], minlength=self.n)
            if but and 0 <= but[i]:
                score[i, but[i]] = -np.inf
        at = np.flatnonzero(np.repeat(self._needed(score, query, k), BLOCK)[: self.n])
        # Most of the rows are read where they lie, few are picked out.
        if 4 * len(at) < self.n:
            score = score[:, at] + query @ self.dense[at].T
        else:
            score += query @ self.dense.T
            at = np.arange(self.n)
        return [self._first(at, own, k) for own in score]

    def _needed(self, score, query, k):
        """Blocks whose bound reaches, for any query, the k-th of the exact cosines in the query's best block."""
        starts = np.arange(0, self.n, BLOCK)
        bound = np.maximum.reduceat(score, starts, axis=1) + query @ self.most.T
        needed = np.zeros(len(starts), bool)
        for own, rare, common in zip(bound, score, query):
            block = slice(start := BLOCK * int(np.argmax(own)), start + BLOCK)
            exact = rare[block] + self.dense[block] @ common
            # A little slack covers the rounding of sums in another order.
            needed |= own >= (np.partition(exact, len(exact) - k)[len(exact) - k] - 1e-9 if k <= len(exact) else -np.inf)
        return needed

    def _first(self, at, score, k):
        """The k largest positive of these scores with their examples, ranked to 12 digits, of equals the earlier."""
        least = np.partition(score, len(score) - k)[len(score) - k] - 1e-9 if k < len(score) else 0.0
        some = np.flatnonzero((score > 0) & (score >= least))
        at, score = at[some], score[some]
        top = np.lexsort((at, -score.round(12)))[:k]
        return at[top], score[top]

    def vectors(self, start, stop):
        """The vectors (places, weights) of the examples from `start` up to `stop`."""
        held = np.flatnonzero((self.example >= start) & (self.example < stop))
        place = np.searchsorted(self.begin, held, side="right") - 1
        order = np.argsort(self.example[held], kind="stable")
        edges = np.searchsorted(self.example[held][order], np.arange(start, stop + 1))
        place, weight = place[order], self.weight[held][order]
        return [(place[a:b], weight[a:b]) for a, b in zip(edges[:-1], edges[1:])]


def vote(similar, toxic, weight):
    """Share of the toxic votes, each counted by its similarity (squared) and by how many rows an example stands for."""
    power = similar**2 * weight
    return float((power * toxic).sum() / power.sum())


def learn(docs, labels, corpus=None):
    """A model from documents (doc_id, text) and labels (doc_id, toxic); what to hold out the caller has removed.

    `corpus` gives the document frequencies, by default `docs`. With labels of one class or none there are no terms, and
    every score is the smoothed share of toxic labels.
    """
    spark = docs.sparkSession
    base.ship(spark)
    examples, sizes = _examples(docs, labels)
    terms, worth = example_terms(examples)
    prior = (sizes.get(1, 0) + 1) / (sizes.get(0, 0) + sizes.get(1, 0) + 2)
    model = {"terms": terms, "prior": prior}
    if not len(terms):
        return model
    total, df = document_frequencies(corpus if corpus is not None else docs, terms)
    model["idf"] = idf = np.log((total + 1) / np.minimum(df + 1, total + 1)) + 1
    idf[: len(terms)] *= worth
    shared = spark.sparkContext.broadcast((terms, idf))

    def vectors(batches):
        own = Terms(shared.value[0])
        for batch in batches:
            found = [vector(own.counts(t), shared.value[1]) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "toxic": batch["toxic"],
                "places": [p.astype(np.int32).tobytes() for p, _ in found], "weights": [w.tobytes() for _, w in found],
            })

    # One buffer holds the vectors; the rows only point into it, and it goes as soon as the index is made of it.
    table = examples.mapInPandas(vectors, "doc_id long, toxic int, places binary, weights binary").toArrow()
    shared.destroy()
    rows = [
        {
            "doc_id": doc, "toxic": toxic,
            "places": np.frombuffer(places.as_buffer(), np.int32), "weights": np.frombuffer(weights.as_buffer()),
        }
        for doc, toxic, places, weights in zip(
            table["doc_id"].to_pylist(), table["toxic"].to_pylist(), table["places"], table["weights"]
        )
    ]
    del table
    # Examples of one leading term lie together, which makes the bounds of blocks tight.
    lead = lambda r: r["places"][int(np.argmax(r["weights"]))] if len(r["places"]) else -1
    rows.sort(key=lambda r: (lead(r), r["doc_id"]))
    picked = Counter(r["toxic"] for r in rows)
    stands_for = {c: sizes[c] / picked[c] for c in picked}
    plain = [r for r in rows if not len(r["places"])]
    rows = [r for r in rows if len(r["places"])]
    model |= {
        "ids": np.array([r["doc_id"] for r in rows]), "toxic": np.array([r["toxic"] for r in rows], float),
        "weight": np.array([stands_for[r["toxic"]] for r in rows]),
        "index": BlockMaxIndex([(r["places"], r["weights"]) for r in rows], len(terms)),
    }
    shares = [sum(stands_for[r["toxic"]] for r in plain if r["toxic"] == c) for c in (0, 1)]
    # Texts without any term are each other's neighbours.
    model["without"] = (shares[1] + prior) / (sum(shares) + 1)
    model["curve"] = calibration(spark, model)
    return model


def votes_of_others(spark, model):
    """(example, vote of the others for it), on the executors; without the examples that no other one resembles."""
    shared = spark.sparkContext.broadcast((model["index"], model["toxic"], model["weight"]))

    def judge(batches):
        index, toxic, weight = shared.value
        for batch in batches:
            for start in range(0, len(batch), AT_ONCE):
                some = batch["id"].iloc[start : start + AT_ONCE].tolist()
                found = index.nearest_each(index.vectors(some[0], some[-1] + 1), NEIGHBOURS, some)
                found = [(i, vote(similar, toxic[near], weight[near])) for i, (near, similar) in zip(some, found) if len(near)]
                yield pd.DataFrame(found, columns=["example", "vote"]).astype({"example": "int64", "vote": "float64"})

    # A partition of a range holds neighbouring numbers.
    rows = spark.range(model["index"].n).mapInPandas(judge, "example long, vote double").toArrow()
    shared.destroy()
    example, votes = rows["example"].to_numpy(), rows["vote"].to_numpy()
    order = np.argsort(example)
    return example[order], votes[order]


def calibration(spark, model):
    """Vote to probability: shares of toxic among the examples, each judged by the others, made monotone by pooling."""
    example, votes = votes_of_others(spark, model)
    order = np.argsort(votes, kind="stable")
    example, pools = example[order], []
    for v, y, w in zip(votes[order], model["toxic"][example], model["weight"][example]):
        if pools and pools[-1][0] == v:
            pools[-1] = [v, pools[-1][1] + w * y, pools[-1][2] + w]
        else:
            pools.append([v, w * y, w])
    merged = []
    for v, up, w in pools:
        merged.append([v, v, up, w])
        while len(merged) > 1 and merged[-2][2] / merged[-2][3] >= merged[-1][2] / merged[-1][3]:
            _, high, up_b, w_b = merged.pop()
            merged[-1] = [merged[-1][0], high, merged[-1][2] + up_b, merged[-1][3] + w_b]
    knots = [(x, up / w) for low, high, up, w in merged for x in ({low, high} if low != high else {low})]
    knots.sort()
    return (np.array([k[0] for k in knots]), np.array([k[1] for k in knots])) if knots else (np.array([0.0, 1.0]), np.array([0.0, 1.0]))


class Scorer:
    """Scores of texts, some at a time."""

    def __init__(self, model):
        self.model, self.terms = model, Terms(model["terms"])

    def scores(self, texts):
        """(score, ids of the nearest examples, their similarities) of each text; null is the empty text."""
        model = self.model
        if not len(model["terms"]):
            return [(model["prior"], [], []) for _ in texts]
        vectors = [vector(self.terms.counts(t or ""), model["idf"]) for t in texts]
        found = model["index"].nearest_each(vectors, NEIGHBOURS)
        out = []
        for near, similar in found:
            if not len(near):
                out.append((model["without"], [], []))
                continue
            share = vote(similar, model["toxic"][near], model["weight"][near])
            out.append((
                float(np.interp(share, *model["curve"])), model["ids"][near[:EVIDENCE]].tolist(), similar[:EVIDENCE].round(6).tolist()
            ))
        return out


REPORT = (
    "doc_id long, held_out boolean, score double, predicted int, nearest array<long>, similarities array<double>"
)


def toxicity_report(docs, model, held_out):
    """One row per document: doc_id, held_out, score, predicted (1 from TOXIC_FROM on), nearest and similarities (evidence).

    `docs` needs doc_id and text. Texts are read whole. A text that shares no term with any example, an empty or a null one
    included, has no neighbours; its score is the share of toxic among examples without terms. Ids may be null or repeated. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    base.ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def scan(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            found = []
            for start in range(0, len(batch), AT_ONCE):
                found += scorer.scores(batch["text"].iloc[start : start + AT_ONCE])
            score = np.array([f[0] for f in found], float)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "score": score,
                "predicted": (score >= TOXIC_FROM).astype(np.int32),
                "nearest": pd.Series([f[1] for f in found], dtype=object),
                "similarities": pd.Series([f[2] for f in found], dtype=object),
            })

    return docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out")).mapInPandas(scan, REPORT)
