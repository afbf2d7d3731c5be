"""Language identification with error-correcting output codes.

Every language has a codeword; one binary classifier per bit, a table of log-odds of hashed byte n-grams, predicts that bit
of the codeword. Decoding takes the codeword of least loss, each bit's loss weighted by how reliable its classifier
proved for that language on rows it had not learned from. A small lead over the second codeword marks a text ambiguous.
"""

import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallyhouse.llm import base

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
# Rows per language that are learned from, about.
PER_LANGUAGE = 3000
# A lead of the best codeword's share below this marks a text ambiguous.
AMBIGUOUS_LEAD = 0.2
# Bytes of a text that are looked up at once.
BLOCK = 1 << 19

_LETTER = re.compile(r"[^\W\d_]")

# Bytes of letters stay, all others of ASCII become one separator.
_CLEAN = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


def codewords(n):
    """A matrix of +1 and -1, a row per class: all different splits of the classes for few, random ones for many."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 6:
        bits = [[1 if i == 0 else 1 - 2 * (split >> (i - 1) & 1) for i in range(n)] for split in range(1, 1 << (n - 1))]
        return np.array(bits, float).T
    best, width = None, int(np.ceil(10 * np.log2(n)))
    rng = np.random.default_rng(7)
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, width))
        apart = (width - code @ code.T) / 2 + np.eye(n) * width
        if best is None or apart.min() > best[0]:
            best = apart.min(), code
    return best[1]


def grams(text):
    """Blocks of hashed byte n-grams of a text, which together hold each n-gram once."""
    data = _CLEAN[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)].astype(np.uint32)
    for start in range(0, len(data), BLOCK):
        own = data[start : start + BLOCK + max(ORDERS) - 1]
        for order in ORDERS:
            n = min(BLOCK, len(own) - order + 1)
            if n <= 0:
                continue
            code = own[:n].copy()
            for shift in range(1, order):
                code = code << np.uint32(8) | own[shift : shift + n]
            yield ((code + np.uint32(order)) * np.uint32(2654435761) >> np.uint32(16)).astype(np.int64) % BUCKETS


def _counts(sample, languages):
    """Counts (language, bucket) of the sample, summed on the executors."""

    def count(batches):
        table = np.zeros((len(languages), BUCKETS), np.int64)
        place = {name: i for i, name in enumerate(languages)}
        for batch in batches:
            for text, name in zip(batch["text"], batch["lang"]):
                for block in grams(text):
                    table[place[name]] += np.bincount(block, minlength=BUCKETS)
        at = np.nonzero(table)
        yield pd.DataFrame({"language": at[0].astype(np.int32), "bucket": at[1].astype(np.int32), "n": table[at]})

    rows = sample.select("text", "lang").mapInPandas(count, "language int, bucket int, n long")
    table = np.zeros((len(languages), BUCKETS))
    for row in rows.groupBy("language", "bucket").agg(F.sum("n").alias("n")).collect():
        table[row["language"], row["bucket"]] = row["n"]
    return table


def bit_weights(counts, code):
    """(bucket, bit) log-odds: mean share of an n-gram over languages whose bit is +1 against those whose bit is -1."""
    share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
    columns = [np.log(share[code[:, j] > 0].mean(axis=0) / share[code[:, j] < 0].mean(axis=0)) for j in range(code.shape[1])]
    return np.array(columns, np.float32).reshape(code.shape[1], BUCKETS).T.copy()


def margins(text, weights):
    """Mean log-odds of a text's n-grams per bit."""
    total, n = np.zeros(weights.shape[1]), 0
    for block in grams(text):
        total += weights[block].sum(axis=0, dtype=np.float64)
        n += len(block)
    return total / max(n, 1)


def losses(margin, code, reliability, sharpness):
    """Weighted logistic loss of each codeword, for rows of margins."""
    per_bit = np.logaddexp(0, -sharpness * margin[:, None, :] * code[None])
    return (per_bit * reliability[None]).sum(axis=2)


def decode(margin, model):
    """(place of the best language, its share, its lead) for rows of margins; ties go to the first language."""
    loss = losses(margin, model["code"], model["reliability"], model["sharpness"])
    share = np.exp(loss.min(axis=1, keepdims=True) - loss)
    share /= share.sum(axis=1, keepdims=True)
    best = loss.argmin(axis=1)
    ordered = np.sort(share, axis=1)
    lead = ordered[:, -1] - ordered[:, -2] if share.shape[1] > 1 else np.ones(len(share))
    return best, share[np.arange(len(best)), best], lead


def learn(rows, per_language=PER_LANGUAGE):
    """A model from rows (doc_id, text, lang). A fifth of the sample judges the bits that the rest has taught."""
    base.ship(rows.sparkSession)
    sample, sizes = base.bounded_sample(rows.where("text is not null"), "lang", per_language)
    languages = sorted(sizes)
    code = codewords(len(languages))
    model = {"languages": languages, "code": code}
    if len(languages) < 2:
        return model
    judge = F.pmod(F.xxhash64("doc_id", F.lit("judge")), F.lit(5)) == 0
    sample = base.stored(sample.select("doc_id", "text", "lang"), "sample")
    taught = sample.where(~judge)
    counts = _counts(taught, languages)
    model["weights"] = weights = bit_weights(counts, code)
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def measure(batches):
        for batch in batches:
            found = [margins(text, shared.value).tolist() for text in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "margin": pd.Series(found, dtype=object)})

    judged = sample.where(judge).select("text", "lang").mapInPandas(measure, "lang string, margin array<double>").collect()
    right = np.ones_like(code)
    seen = np.full((len(languages), 1), 2.0)
    place = {name: i for i, name in enumerate(languages)}
    for row in judged:
        at = place[row["lang"]]
        right[at] += np.array(row["margin"]) * code[at] > 0
        seen[at] += 1
    reliability = right / seen
    model["reliability"] = reliability / reliability.mean(axis=1, keepdims=True)
    # The sharpness that makes the shares most likely on the judging rows.
    model["sharpness"] = 8.0
    if judged:
        margin = np.array([row["margin"] for row in judged])
        truth = np.array([place[row["lang"]] for row in judged])

        def likelihood(sharpness):
            loss = losses(margin, code, model["reliability"], sharpness)
            logs = -loss - np.log(np.exp(loss.min(axis=1, keepdims=True) - loss).sum(axis=1, keepdims=True)) + loss.min(axis=1, keepdims=True)
            return logs[np.arange(len(truth)), truth].mean()

        model["sharpness"] = max((0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0), key=likelihood)
    return model


RESULT = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"


def predict(docs, model, held_out):
    """One row per document: doc_id, held_out, lang_pred, score, ambiguous.

    `docs` needs doc_id and text; `held_out` is a boolean column expression. A text that is null or has no letter is
    `und` with score 0 and ambiguous; so is every text if no language was learned. Texts are read whole, however long.
    Ids may be null or repeated. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    base.ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def scan(batches):
        own = shared.value
        languages = own["languages"]
        for batch in batches:
            known = np.array([isinstance(t, str) and _LETTER.search(t) is not None for t in batch["text"]], bool)
            known &= len(languages) > 0
            name = np.full(len(batch), UNKNOWN, dtype=object)
            score, ambiguous = np.zeros(len(batch)), np.ones(len(batch), bool)
            if len(languages) == 1:
                name[known], score[known], ambiguous[known] = languages[0], 1.0, False
            elif known.any():
                found = np.array([margins(t, own["weights"]) for t, k in zip(batch["text"], known) if k])
                best, share, lead = decode(found, own)
                name[known] = [languages[b] for b in best]
                score[known], ambiguous[known] = share, lead < AMBIGUOUS_LEAD
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "lang_pred": name,
                "score": score, "ambiguous": ambiguous,
            })

    return docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out")).mapInPandas(scan, RESULT)
