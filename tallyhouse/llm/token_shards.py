"""Token ids of a corpus in document order, in wavelet matrix files, and what is read back from them.

The corpus is sorted by id over range partitions, each of which writes its documents as files of bounded size. Spark's
writer commits them (one row of a Parquet container holds the bytes of one file), so that any file system Spark can write
will do and a task that is lost leaves nothing behind.
"""

import zlib

import numpy as np
import pandas as pd
from public_tokenizers import PATTERN
from pyspark import TaskContext
from pyspark.sql import functions as F

from tallyhouse.llm import base
from tallyhouse.llm.tokens import Remembering, pattern
from tallyhouse.llm.wavelet import from_file, to_file

# Ids in one file, about; a document is never divided.
SHARD_IDS = 1_000_000
END_ID = 0
# What most often follows a word; each is a match by itself behind letters.
MARKS = frozenset(".,;:!?)\"")

SHARD_SCHEMA = "part int, number int, start long, n_tokens long, n_docs int, content binary"

_TOKENIZERS = {}


def byte_letters():
    """The letter that byte-level vocabularies write for each byte: printing ones stand for themselves."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return "".join(letters[b] for b in range(256))


class Encoding:
    """Ids as the library's `encode(text, add_special_tokens=False)` gives them.

    Matches of the pattern are encoded by the library's model and remembered with the parts of texts they stand in. Texts
    that can't be cut, and texts that hold one of the tokenizer's added tokens, go through the library as a whole.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        self.library = own
        self.bits = max(1, (own.get_vocab_size() - 1).bit_length())
        self.added = [token.content for token in own.get_added_tokens_decoder().values()]
        tokenize, letters, find = own.model.tokenize, byte_letters(), pattern(PATTERN).findall

        def whole_match(match):
            # Letters of ASCII stand for themselves; of the rest only the space before them may be plain.
            if match.isascii() and match.lstrip(" ").isalpha():
                match = match.replace(" ", letters[32])
            else:
                match = match.encode().decode("latin-1").translate(letters)
            return [t.id for t in tokenize(match)]

        def encode(part):
            # Letters, with or without a space before them, are one match; so is the mark behind them.
            if (part[1:] if part[0] == " " else part).isalpha():
                return whole_match(part)
            if part[-1] in MARKS and (part[1:-1] if part[0] == " " else part[:-1]).isalpha():
                return self.memory[part[:-1]] + self.memory[part[-1]]
            matches = find(part)
            if len(matches) == 1:
                return whole_match(part)
            # A match is a part too, and remembered like one.
            return b"".join(map(self.memory.__getitem__, matches))

        self.memory = Remembering(encode, whole=self.whole)

    def whole(self, text):
        return self.library.encode(text, add_special_tokens=False).ids

    def ids(self, text):
        """Ids of a text; null is the empty text."""
        if text and any(token in text for token in self.added):
            return np.asarray(self.whole(text), "<u4")
        return self.memory.ids(text)


def tokenizer(path):
    """The encoding of a byte-level tokenizers file, kept per Python process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Encoding(path)
    return _TOKENIZERS[path]


def shards(docs, path, end_id=END_ID, shard_ids=SHARD_IDS):
    """Rows (part, number, start, n_tokens, n_docs, content): files in order of (part, number).

    `start` counts the ids before the file within its part.
    """

    def write(batches):
        own_ids = tokenizer(path)
        bits = own_ids.bits
        kind = np.uint16 if bits <= 16 else np.uint32
        part, number, start = TaskContext.get().partitionId(), 0, 0
        ids, docs_held, held = [], [], 0
        end = np.array([end_id], kind)

        def file():
            ends = np.cumsum([len(i) for i in ids])
            content = to_file(np.concatenate(ids), bits, docs_held, ends)
            return pd.DataFrame({
                "part": [part], "number": [number], "start": [start], "n_tokens": [held], "n_docs": [len(ids)],
                "content": [content],
            })

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                own = np.concatenate([own_ids.ids(text).astype(kind), end])
                ids.append(own)
                docs_held.append(None if pd.isna(doc) else int(doc))
                held += len(own)
                if held >= shard_ids:
                    yield file()
                    number, start = number + 1, start + held
                    ids, docs_held, held = [], [], 0
        if ids:
            yield file()

    # Equal and null ids are put in order by their texts, so that a retried task writes the same files.
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return ordered.mapInPandas(write, SHARD_SCHEMA)


def write_shards(docs, path, folder=None, end_id=END_ID, shard_ids=SHARD_IDS):
    """Write the files and return them as a table; `folder` is any place Spark can write, by default the shared folder."""
    base.ship(docs.sparkSession)
    files = shards(docs, path, end_id, shard_ids)
    if folder is None:
        return base.stored(files, "shards")
    files.write.mode("overwrite").parquet(folder)
    return docs.sparkSession.read.schema(files.schema).parquet(folder)


def with_offsets(files):
    """Files with `start` counted over the whole corpus. The totals of the parts, one number per task, pass the driver."""
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before = np.cumsum([0] + [row["n"] for row in totals]).tolist()
    offsets = files.sparkSession.createDataFrame(
        [(row["part"], start) for row, start in zip(totals, before)], "part int, before long"
    )
    return files.join(offsets, "part").withColumn("start", F.col("start") + F.col("before")).drop("before")


def read_documents(files):
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32.

    `start` counts the ids of all documents before it, `n_tokens` its ids with the end id; the checksum is over the ids
    as little-endian unsigned 32-bit numbers.
    """

    def read(batches):
        for batch in batches:
            for start, content in zip(batch["start"], batch["content"]):
                matrix, ids, ends = from_file(content)
                values = matrix.values().astype("<u4")
                begins = np.r_[0, ends[:-1]]
                yield pd.DataFrame({
                    "doc_id": pd.array(ids, "Int64"), "start": start + begins, "n_tokens": ends - begins,
                    "ids_crc32": [zlib.crc32(values[a:b].tobytes()) for a, b in zip(begins, ends)],
                })

    return with_offsets(files).select("start", "content").mapInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_report(docs, path, end_id=END_ID):
    """Encode, write, read back: see `read_documents`.

    `docs` needs doc_id and text. A null text has the end id only. Null ids come first; rows of equal ids each count as
    a document, in the order of a hash of their texts. An empty table gives an empty result.
    """
    return read_documents(write_shards(docs, path, end_id=end_id))
