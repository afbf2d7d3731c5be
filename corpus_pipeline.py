"""A corpus made ready for training: stages over `documents`, each written and read again before the next."""

import public_tokenizers
from pyspark.sql import functions as F

from tallyhouse.llm import base, byte_bpe, decontamination, ngram_join, quality_cnn, substring_dedup

# Stages share the executors' Python workers: each but the first begins by having them release what the last one left.

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_classifier(spark, docs, sf_dir):
    """Documents that the byte network scores as good. It learns from labels of three folds in four."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(base.crc_remainder("doc_id", 4) != 2)
    return quality_cnn.good_documents(docs, quality_cnn.learn(docs, labels))


def ngram_jaccard_join(spark, docs, sf_dir):
    """One document of each near-duplicate group."""
    base.release_workers(spark)
    return ngram_join.one_per_group(docs)


def substring_dedup_stage(spark, docs, sf_dir):
    """Texts without passages that stand anywhere else; n_chars follows the text."""
    base.release_workers(spark)
    cleaned = substring_dedup.without_repeats(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents without passages of the benchmark."""
    base.release_workers(spark)
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


# The last stage shares its workers with what earlier stages left there: it remembers less than op2 does.
STAGE_BYTES, STAGE_PAIRS = 24 << 20, 200_000


def byte_bpe_stage(spark, docs, sf_dir):
    """Token ids of every document, and whether they decode to its text."""
    base.release_workers(spark)
    own = docs.select("doc_id", "lang", "source", "n_chars", "text")
    return byte_bpe.with_tokens(own, RANKS, public_tokenizers.PATTERN, STAGE_BYTES, STAGE_PAIRS)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup_stage),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe_stage),
]

# The first stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to `documents`; what each leaves is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = base.stored(stage(spark, docs, sf_dir), name)
    return docs
