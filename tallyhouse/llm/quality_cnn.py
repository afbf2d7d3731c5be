"""Quality classifier: a convolutional network over bytes, in numpy.

Bytes are embedded, filters look at runs of `WIDTH` bytes every `STRIDE` bytes of the whole document. A chunk is two hops
long and begins at every hop, so that chunks overlap by half; each filter's response is max-pooled per chunk. The mean and
the maximum over the chunks feed a logistic unit. All weights are learned, by gradients through the pooled positions.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallyhouse.llm import base

EMBEDDED, WIDTH, STRIDE, FILTERS = 8, 8, 4, 24
# Positions of filters in half a chunk: 128 positions are 512 bytes.
HOP = 128
# Share of good texts of which a short fragment is learned too: a fragment of a good text is good, one of a bad text need not
# be bad.
FRAGMENTS, FRAGMENT_LENGTH = 0.6, (15, 300)
# Texts per class that are learned from, about, and the longest of them in characters (longer ones only get scored).
PER_CLASS, LONGEST = 2000, 50_000
EPOCHS, BATCH, RATE = 6, 32, 0.01
KEEP_FROM = 0.7
# Bytes of a document that are convolved at once: a whole number of hops.
BLOCK = 512 * HOP * STRIDE


def new_model(seed=11):
    rng = np.random.default_rng(seed)
    return {
        "embedding": rng.normal(0, 0.5, (256, EMBEDDED)).astype(np.float32),
        "filters": rng.normal(0, 1 / np.sqrt(WIDTH * EMBEDDED), (WIDTH * EMBEDDED, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "out": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "offset": np.zeros(1, np.float32),
    }


def _bytes(text):
    data = np.frombuffer((text or "").encode(), np.uint8)
    short = WIDTH - len(data)
    return np.concatenate([data, np.zeros(short, np.uint8)]) if short > 0 else data


def responses(data, model):
    """(position, filter) responses at every STRIDE-th byte; a tail shorter than a filter is seen by one more, at the end."""
    embedded = model["embedding"][data]
    n = (len(data) - WIDTH) // STRIDE + 1
    out = np.empty((n, FILTERS), np.float32)
    per_run = WIDTH // STRIDE
    for phase in range(per_run):
        # Runs of one phase don't overlap, so they are a view of the embedded bytes.
        m = len(range(phase, n, per_run))
        view = embedded[phase * STRIDE : phase * STRIDE + m * WIDTH].reshape(m, WIDTH * EMBEDDED)
        out[phase::per_run] = view @ model["filters"]
    if (len(data) - WIDTH) % STRIDE:
        out = np.concatenate([out, embedded[-WIDTH:].reshape(1, -1) @ model["filters"]])
    return out + model["bias"]


def _hop_maxima(data, model):
    out = responses(data, model)
    return np.maximum.reduceat(out, np.arange(0, len(out), HOP), axis=0)


def features(data, model):
    """Mean and maximum over the chunks of a document."""
    if len(data) <= BLOCK:
        hops = _hop_maxima(data, model)
    else:
        parts = []
        for start in range(0, len(data), BLOCK):
            # The overlap lets runs cross the border of blocks; a tail too short for a run was seen by the block before.
            part = data[start : start + BLOCK + WIDTH - STRIDE]
            if len(part) >= WIDTH:
                parts.append(_hop_maxima(part, model))
        hops = np.concatenate(parts)
    chunks = np.maximum(hops[:-1], hops[1:]) if len(hops) > 1 else hops
    chunks = np.maximum(chunks, 0)
    return np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)])


def probability(text, model):
    """Score of a text; null is the empty text."""
    z = float(features(_bytes(text), model) @ model["out"] + model["offset"][0])
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _gradients(batch, labels, model):
    """Gradients of the mean logistic loss over a batch of byte arrays."""
    grads = {name: np.zeros_like(value) for name, value in model.items()}
    for data, label in zip(batch, labels):
        out = responses(data, model)
        starts = np.arange(0, len(out), HOP)
        hops = np.maximum.reduceat(out, starts, axis=0)
        where = np.array([s + out[s : s + HOP].argmax(axis=0) for s in starts])
        if len(hops) > 1:
            later = hops[1:] > hops[:-1]
            chunks = np.where(later, hops[1:], hops[:-1])
            where = np.where(later, where[1:], where[:-1])
        else:
            chunks = hops
        chunks = np.maximum(chunks, 0)
        top = chunks.argmax(axis=0)
        z = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)])
        p = 1 / (1 + np.exp(-np.clip(z @ model["out"] + model["offset"][0], -30, 30)))
        error = np.float32((p - label) / len(labels))
        grads["out"] += error * z
        grads["offset"] += error
        slope = np.repeat((error * model["out"][:FILTERS] / len(chunks))[None], len(chunks), axis=0)
        slope[top, np.arange(FILTERS)] += error * model["out"][FILTERS:]
        slope *= chunks > 0
        rows, columns = np.nonzero(slope)
        if not len(rows):
            continue
        gain = slope[rows, columns]
        begin = np.minimum(where[rows, columns] * STRIDE, len(data) - WIDTH)
        run = data[begin[:, None] + np.arange(WIDTH)]
        seen = model["embedding"][run].reshape(len(rows), -1)
        weight = np.zeros((len(rows), FILTERS), np.float32)
        weight[np.arange(len(rows)), columns] = gain
        grads["filters"] += seen.T @ weight
        grads["bias"] += weight.sum(axis=0)
        back = (model["filters"].T[columns] * gain[:, None]).reshape(-1, EMBEDDED)
        np.add.at(grads["embedding"], run.reshape(-1), back)
    return grads


def fragments(texts, rng):
    """Short runs of words out of some of the texts."""
    out = []
    for text in texts:
        if rng.random() < FRAGMENTS:
            at = text.find(" ", int(rng.integers(0, len(text) + 1))) + 1
            stop = text.find(" ", at + int(rng.integers(*FRAGMENT_LENGTH)))
            out.append(text[at : stop if stop > 0 else None])
    return out


def train(texts, labels, seed=11, epochs=EPOCHS):
    """A model from texts and labels 0/1, by Adam over shuffled batches; repeatable."""
    model = new_model(seed)
    rng = np.random.default_rng(seed)
    short = fragments([t for t, label in zip(texts, labels) if label == 1], rng)
    data = [_bytes(t) for t in [*texts, *short]]
    labels = np.asarray([*labels, *[1] * len(short)], np.float32)
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    step = 0
    total = epochs * -(-len(data) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            grads = _gradients([data[i] for i in chosen], labels[chosen], model)
            step += 1
            rate = RATE * (1 - 0.9 * step / total)
            for name, g in grads.items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                model[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return model


def learn(docs, labels, per_class=PER_CLASS):
    """A model from documents (doc_id, text) and labels (doc_id, quality); what to hold out the caller has removed.

    About `per_class` labelled rows of each class are fetched. Their classes are then weighed as in all labels: the
    offset moves by the logarithm of how much more often one class was picked. With no labels every score is 0.5; with
    one class, its smoothed share.
    """
    labels = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked, sizes = base.bounded_sample(labels, "quality", per_class)
    # The sample's size has a bound, whatever the size of the table.
    texts = docs.select("doc_id", "text").where(F.length("text") <= LONGEST)
    rows = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "quality")
    rows = sorted({(r["doc_id"], r["text"], r["quality"]) for r in rows.collect()})
    seen = {0: sum(r[2] == 0 for r in rows), 1: sum(r[2] == 1 for r in rows)}
    if not seen[0] or not seen[1]:
        model = new_model()
        model["out"] = np.zeros_like(model["out"])
        model["offset"][0] = np.log((sizes.get(1, 0) + 1) / (sizes.get(0, 0) + 1))
        return model
    model = train([r[1] for r in rows], [r[2] for r in rows])
    model["offset"][0] += np.log(sizes[1] / sizes[0]) - np.log(seen[1] / seen[0])
    return model


def score_column(spark, model):
    """A function of a text column that gives its score; every text is read whole, null is the empty text."""
    base.ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([probability(t, shared.value) for t in texts], dtype=float)

    return score


def good_documents(docs, model, least=0.5):
    """The rows of `docs` that score at least `least`, with all their columns."""
    return docs.where(score_column(docs.sparkSession, model)("text") >= least)


def quality_report(docs, model, held_out):
    """One row per document: doc_id, held_out, score, predicted (1 from KEEP_FROM on).

    `docs` needs doc_id and text; ids may be null or repeated; empty and null texts get a score too. An empty table
    gives an empty result.
    """
    score = score_column(docs.sparkSession, model)
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= KEEP_FROM).cast("int"))
