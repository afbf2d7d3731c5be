"""Quality rules with a log-likelihood ratio of hashed n-grams, in DataFrame functions but for a filter of ids.

Words and pairs of words are hashed into a fixed number of buckets. Two multinomials over the buckets are estimated: of
trusted target texts and of the whole raw corpus. A document's score is the mean logarithm of their ratio over its
n-grams; every document is decided by a fixed threshold on it, so a rerun decides alike. Ratios are held as whole
millionths: sums do not depend on the order of rows or tasks.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallyhouse.llm import base

# White space between words, as a pattern.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
BUCKETS = 10_000
UNIT = 1_000_000
# A document whose n-grams are, in the mean, this much likelier in the raw corpus than in the target (nats) goes.
THRESHOLD = -0.12
LEAST_WORDS, MOST_REPEATED = 50, 50


def with_words(docs):
    """`docs` with the array column `words`; a null text has none."""
    return docs.withColumn("words", F.expr(rf"filter(split(coalesce(text, ''), r'{SPACE}'), x -> x <> '')"))


def gram_buckets(words="words"):
    """Buckets of the words and of the pairs of neighbouring words, as an array."""
    return F.expr(
        f"concat(transform({words}, x -> pmod(xxhash64(x), {BUCKETS}L)), "
        f"transform({words}, (x, i) -> if(i = 0, -1L, pmod(xxhash64({words}[i - 1], x), {BUCKETS}L))))"
    )


def flagged_texts(docs, trusted):
    """(text, target) of every document, target being 1 for trusted ones and 0 for others.

    A filter of fixed size passes all trusted ids and few others: what it holds back is not trusted and needs no join.
    """
    flags = trusted.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("t_id")).distinct()
    base.ship(docs.sparkSession)
    shared = base.membership_filter(flags, "t_id")

    @F.pandas_udf("boolean")
    def maybe(ids: pd.Series) -> pd.Series:
        return pd.Series(base.maybe_member(shared.value, ids.to_numpy(np.int64).view(np.uint64)))

    # A null id is never trusted; the filter itself gets no nulls.
    rows = docs.withColumn("maybe", F.col("doc_id").isNotNull() & maybe(F.coalesce(F.col("doc_id").cast("long"), F.lit(0))))
    near = rows.where("maybe").join(flags, F.col("doc_id") == F.col("t_id"), "left")
    near = near.select("text", F.col("t_id").isNotNull().cast("long").alias("target"))
    return near.union(rows.where("not maybe").select("text", F.lit(0).cast("long").alias("target")))


def ratios(docs, trusted):
    """Log-ratio of target to raw per bucket, in millionths, as a list of BUCKETS numbers.

    `trusted` is a table of doc_ids, of any size; without trusted documents all ratios are 0. Counts are summed per bucket
    before they are shuffled. Only texts that may be trusted are shuffled to the ids, if these are too many to be broadcast.
    """
    flagged = flagged_texts(docs, trusted)
    grams = with_words(flagged)
    counts = (
        grams.select("target", F.explode(gram_buckets()).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum("target").alias("target"))
        .where("bucket >= 0")
        .collect()
    )
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for row in counts:
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    if target.sum() == BUCKETS:
        return [0] * BUCKETS
    found = np.log(target / target.sum()) - np.log(raw / raw.sum())
    return [int(x) for x in np.round(found * UNIT)]


def trusted_ids(labels):
    """doc_ids of all labelled good documents."""
    return labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()


def repeated_words(docs):
    """`docs` (with `words`) with n_repeat_words: words inside a run of three that stands in the text twice or more.

    Runs are sorted by hash with their places; neighbours of equal hash are repeated. Linearithmic however long the text.
    """
    runs = docs.withColumn(
        "runs",
        F.expr("if(size(words) < 3, array(), transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])))"),
    )
    # Sorting is only needed where some run is repeated.
    runs = runs.withColumn("repeats", F.expr("size(runs) > size(array_distinct(runs))"))
    runs = runs.withColumn(
        "sorted", F.expr("if(repeats, array_sort(transform(runs, (x, i) -> struct(x as h, i as i))), array())")
    )
    # Each entry beside the hashes before and after it, so that no function looks back into the array by index.
    runs = runs.withColumn("hashes", F.expr("transform(sorted, x -> x.h)"))
    runs = runs.withColumn(
        "places",
        F.expr(
            "if(repeats, array_sort(transform(filter(arrays_zip(sorted, concat(array(cast(null as bigint)), hashes) , "
            "concat(slice(hashes, 2, size(hashes)), array(cast(null as bigint)))), "
            "x -> x.sorted.h = x.`1` or x.sorted.h = x.`2`), x -> x.sorted.i)), array())"
        ),
    )
    # A place covers three words, less those that the next place covers.
    covered = (
        "if(size(places) = 0, 0L, 3L + aggregate(zip_with(slice(places, 2, size(places)), slice(places, 1, size(places) - 1), "
        "(b, a) -> cast(least(3, b - a) as bigint)), 0L, (s, x) -> s + x))"
    )
    return runs.withColumn("n_repeat_words", F.expr(covered)).drop("runs", "repeats", "sorted", "hashes", "places")


def base_counts(docs):
    """doc_id, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every document."""
    rows = with_words(docs)
    rows = rows.withColumn("lines", F.expr(r"filter(split(coalesce(text, ''), '\n'), x -> x rlike r'[^\x20\x09-\x0D]')"))
    rows = rows.select(
        "doc_id",
        "words",
        F.expr("cast(size(words) as long)").alias("n_words"),
        F.expr("cast(length(array_join(words, '')) as long)").alias("word_chars"),
        F.expr(f"cast(length(regexp_replace(coalesce(text, ''), r'{SYMBOLS}', '')) as long)").alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as long)").alias("n_dup_lines"),
    )
    return repeated_words(rows)


def quality_rules(docs, trusted, threshold=THRESHOLD):
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score.

    `docs` needs doc_id and text, `trusted` doc_ids of target documents. A null text counts as
    empty, has no words and fails the base rules. The score is in nats per n-gram, 0 without n-grams. Ids may be null or
    repeated. An empty table gives an empty result.
    """
    table = ratios(docs.select("doc_id", "text"), trusted)
    weights = F.lit(np.array([*table, 0], np.int64))
    rows = base_counts(docs.select("doc_id", "text"))
    # Place BUCKETS holds 0, for the pair that the first word doesn't have.
    rows = rows.withColumn("grams", gram_buckets())
    total = F.aggregate("grams", F.lit(0).cast("long"), lambda s, g: s + F.get(weights, F.when(g < 0, BUCKETS).otherwise(g).cast("int")))
    rows = rows.withColumn("total", total).withColumn("n_grams", F.greatest(2 * F.col("n_words") - 1, F.lit(1)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("total") >= F.lit(round(threshold * UNIT)) * F.col("n_grams"))).alias("kept"),
        (F.col("total") / F.col("n_grams") / UNIT).alias("score"),
    )
