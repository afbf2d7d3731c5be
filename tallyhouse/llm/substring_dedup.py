"""Substring dedup: removes every word inside a run of `width` words that also starts anywhere else.

1. Sketch: each task counts, in a count-min sketch, the anchors of its windows. A window's anchor is the q-gram of least
   hash inside it (the leftmost of equals), so equal windows have equal anchors at equal places: the estimate of the
   anchor is never below the count of the window. One anchor serves up to `width - q + 1` windows, which keeps the
   sketch small. The partitions' sketches are merged; cells stop at two, as only "once" and "repeated" matter.
2. Windows estimated repeated are grouped exactly by their 96-bit hashes. They travel as blocks per (bucket, task): a
   hash goes to its bucket once per task with a mark if the task saw it twice, so a passage in a third of all documents
   sends one entry per task, not one per document. The answer, a bit per entry, comes back to the same (bucket, task),
   where the places of the entries wait.
3. Places of repeated windows join their documents, which drop the covered words.

The sketch has a fixed size: a fuller one lets more windows reach the exact pass and loses none.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from tallyhouse.llm import base

WIDTH = 35
GRAM = 8
ROWS, CELLS = 2, 1 << 26
# Windows a task holds before it gives them out, and windows a bucket should have.
HELD, BUCKET_WINDOWS = 1_000_000, 1_000_000
BUCKETS_AT_LEAST = 64
# Documents are scanned in spans of at most so many words (overlapping by one window).
SPAN = 1 << 20
_PLACE = np.uint64(SPAN - 1)


def words_of(text):
    """Words between ASCII white space, unchanged, as bytes."""
    return text.encode().split() if text else []


def _leftmost_least(packed, width):
    """Least value of every run of `width` values."""
    size = 1
    while 2 * size <= width:
        packed = np.minimum(packed[:-size], packed[size:])
        size *= 2
    rest = width - size
    return np.minimum(packed[: len(packed) - rest], packed[rest:]) if rest else packed


def anchors(hashes, width=WIDTH, gram=GRAM):
    """For every window of a span: its anchor's hash (44 bits) with the anchor's place in the low 20 bits."""
    grams = base.run_hashes(hashes, gram)
    packed = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    return _leftmost_least(packed, width - gram + 1)


def spans(hashes, width=WIDTH):
    """(offset, hashes) of overlapping spans that hold every window of a document once."""
    step = SPAN - width
    for start in range(0, max(1, len(hashes) - width + 1), step):
        yield start, hashes[start : start + step + width - 1]


def _window_keys(hashes, width):
    """Two hashes of every window, 64 and 32 bits."""
    first = base.run_hashes(hashes, width)
    second = (base.run_hashes(hashes, width, 0xD1342543DE82EF95) >> np.uint64(32)).astype(np.uint32)
    return first, second


def _sketch_cells(anchor):
    """The cell of each row of the sketch for anchor hashes, rows one after the other."""
    mixed = base.mixed(anchor & ~_PLACE)
    half = np.uint64(CELLS // ROWS)
    return [(mixed % half).astype(np.int64), ((mixed >> np.uint64(32)) % half).astype(np.int64) + CELLS // ROWS]


def _distinct_anchors(least):
    """Anchors at different places, each once: places never move backwards from window to window."""
    return least[np.r_[True, least[1:] != least[:-1]]] if len(least) else least


CELL_SCHEMA = "slice int, cells binary, n_words long"


def scan_sketch(docs, width=WIDTH, gram=GRAM):
    """Per task and slice of the sketch: the cells it met once, and those it met again; and its number of words."""
    per_slice = CELLS // base.SLICES

    def scan(batches):
        found, words, held = [[], []], 0, 0

        def given_out():
            cells, counts = np.unique(np.concatenate(found[0] + found[1]), return_counts=True)
            edges = np.searchsorted(cells, np.arange(base.SLICES + 1) * per_slice)
            rows = []
            for number in range(base.SLICES):
                part = slice(edges[number], edges[number + 1])
                own = (cells[part] - number * per_slice).astype(np.uint32)
                if len(own):
                    # The top bit marks cells met more than once.
                    own |= (counts[part] > 1).astype(np.uint32) << np.uint32(31)
                    rows.append((number, own.tobytes(), 0))
            return pd.DataFrame(rows, columns=["slice", "cells", "n_words"])

        for batch in batches:
            for text in batch["text"]:
                own = words_of(text)
                words += len(own)
                if len(own) < width:
                    continue
                for _, hashes in spans(base.word_hashes(own), width):
                    for row, cells in enumerate(_sketch_cells(_distinct_anchors(anchors(hashes, width, gram)))):
                        found[row].append(cells)
                        held += len(cells)
            if held > 4 * HELD:
                yield given_out()
                found, held = [[], []], 0
        if held:
            yield given_out()
        yield pd.DataFrame({"slice": pd.array([None], "Int32"), "cells": [None], "n_words": [words]})

    return docs.select("text").mapInPandas(scan, CELL_SCHEMA)


def repeated_cells(sketch):
    """The merged sketch as one bit per cell: met at least twice."""
    per_slice = CELLS // base.SLICES

    def streamed(batches):
        tables = {}
        for batch in batches:
            for number, cells in zip(batch["slice"], batch["cells"]):
                table = tables.setdefault(number, np.zeros(per_slice, np.uint8))
                cells = np.frombuffer(cells, np.uint32)
                at = cells & np.uint32(0x7FFFFFFF)
                table[at] = np.minimum(table[at] + 1 + (cells >> np.uint32(31)).astype(np.uint8), 2)
        for number, table in tables.items():
            yield pd.DataFrame({"slice": [number], "cells": [np.packbits(table == 2).tobytes()]})

    rows = sketch.where("slice is not null").select("slice", "cells")
    merged = rows.repartition(base.SLICES, "slice").mapInPandas(streamed, base.SLICE_SCHEMA).collect()
    parts = [np.zeros(per_slice // 8, np.uint8)] * base.SLICES
    for row in merged:
        parts[row["slice"]] = np.frombuffer(row["cells"], np.uint8)
    return np.concatenate(parts)


def _estimated_repeated(bits, least):
    """Whether the sketch gives each window's anchor two or more."""
    keep = np.ones(len(least), bool)
    for cells in _sketch_cells(least):
        keep &= (bits[cells >> 3] >> (7 - (cells & 7)) & 1).astype(bool)
    return keep


BLOCK_SCHEMA = "bucket int, task string, keys binary, places binary"
_RUN = np.dtype([("doc", "<i8"), ("none", "u1"), ("text_key", "<i8"), ("start", "<u4"), ("length", "<u4")])


def scan_windows(docs, bits, buckets, width=WIDTH, gram=GRAM):
    """Blocks of the windows estimated repeated: distinct keys with a mark for several, and the runs they come from."""

    def scan(batches):
        runs, keys, order, held, turn = [], [], [], 0, 0
        task = TaskContext.get().partitionId()

        def given_out():
            first = np.concatenate([k[0] for k in keys])
            second = np.concatenate([k[1] for k in keys])
            table = np.concatenate(runs)
            bucket = np.concatenate(order)
            lengths = table["length"].astype(np.int64)
            begin = np.cumsum(lengths) - lengths
            by_bucket = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
            rows = []
            for number in range(buckets):
                own = by_bucket[edges[number] : edges[number + 1]]
                if not len(own):
                    continue
                size = lengths[own]
                at = np.repeat(begin[own] - np.cumsum(size) + size, size) + np.arange(size.sum())
                pair = np.empty(len(at), [("first", "<u8"), ("second", "<u4")])
                pair["first"], pair["second"] = first[at], second[at]
                unique, which, counts = np.unique(pair, return_inverse=True, return_counts=True)
                block = unique["first"].tobytes() + unique["second"].tobytes() + np.packbits(counts > 1).tobytes()
                places = len(own).to_bytes(4, "little") + table[own].tobytes() + which.astype(np.uint32).tobytes()
                rows.append((number, f"{task}-{turn}", block, places))
            return pd.DataFrame(rows, columns=["bucket", "task", "keys", "places"])

        for batch in batches:
            for doc, text, text_key in zip(batch["doc_id"], batch["text"], batch["text_key"]):
                own = words_of(text)
                if len(own) < width:
                    continue
                for offset, hashes in spans(base.word_hashes(own), width):
                    least = anchors(hashes, width, gram)
                    keep = _estimated_repeated(bits.value, least)
                    if not keep.any():
                        continue
                    # A run: consecutive windows with one anchor at one place. All of it belongs to the anchor's bucket.
                    at = np.flatnonzero(keep)
                    fresh = np.r_[True, (least[at[1:]] != least[at[:-1]]) | (at[1:] != at[:-1] + 1)]
                    starts = np.flatnonzero(fresh)
                    table = np.zeros(len(starts), _RUN)
                    table["doc"], table["none"], table["text_key"] = (0, 1, text_key) if pd.isna(doc) else (doc, 0, text_key)
                    table["start"] = at[starts] + offset
                    table["length"] = np.diff(np.r_[starts, len(at)])
                    runs.append(table)
                    order.append((base.mixed(least[at[starts]] & ~_PLACE) % np.uint64(buckets)).astype(np.int64))
                    first, second = _window_keys(hashes, width)
                    keys.append((first[at], second[at]))
                    held += len(at)
                    if held >= HELD:
                        yield given_out()
                        runs, keys, order, held, turn = [], [], [], 0, turn + 1
        if held:
            yield given_out()

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInPandas(scan, BLOCK_SCHEMA)


def _keys(block):
    n = (len(block) * 8) // 97
    while 12 * n + (n + 7) // 8 < len(block):
        n += 1
    first, second = np.frombuffer(block, "<u8", n), np.frombuffer(block, "<u4", n, 8 * n)
    return first, second, np.unpackbits(np.frombuffer(block, np.uint8, offset=12 * n), count=n).astype(bool)


def repeated_keys(blocks):
    """(bucket, task, answer): a bit for each key of a block, set if the key stands for two or more windows in all."""

    def in_bucket(rows):
        parts = [_keys(block) for block in rows["keys"]]
        first = np.concatenate([p[0] for p in parts])
        second = np.concatenate([p[1] for p in parts])
        several = np.concatenate([p[2] for p in parts])
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        group = np.cumsum(new) - 1
        again = np.bincount(group) > 1
        again |= np.bincount(group, several[order]) > 0
        answer = np.empty(len(first), bool)
        answer[order] = again[group]
        edges = np.cumsum([0] + [len(p[0]) for p in parts])
        answers = [np.packbits(answer[x:y]).tobytes() for x, y in zip(edges[:-1], edges[1:])]
        return pd.DataFrame({"bucket": rows["bucket"], "task": rows["task"], "answer": answers})

    return blocks.select("bucket", "task", "keys").groupBy("bucket").applyInPandas(
        in_bucket, "bucket int, task string, answer binary"
    )


def repeated_places(blocks, answers):
    """(doc_id, text_key, starts): starts of repeated windows, as the bytes of 32-bit numbers."""

    def resolve(batches):
        for batch in batches:
            ids, texts, found = [], [], []
            for places, answer in zip(batch["places"], batch["answer"]):
                n = int.from_bytes(places[:4], "little")
                table = np.frombuffer(places, _RUN, n, 4)
                which = np.frombuffer(places, np.uint32, offset=4 + n * _RUN.itemsize)
                yes = np.unpackbits(np.frombuffer(answer, np.uint8)).astype(bool)[which]
                size = table["length"].astype(np.int64)
                starts = np.repeat(table["start"] - np.cumsum(size) + size, size) + np.arange(size.sum())
                owner = np.repeat(np.arange(n), size)[yes]
                starts = starts[yes].astype(np.uint32)
                if not len(starts):
                    continue
                # Runs of one document lie side by side.
                same = (table["doc"][1:] == table["doc"][:-1]) & (table["text_key"][1:] == table["text_key"][:-1])
                document = np.cumsum(np.r_[0, ~same | (table["none"][1:] != table["none"][:-1])])[owner]
                cuts = np.flatnonzero(np.r_[True, document[1:] != document[:-1]])
                for x, y in zip(cuts, np.r_[cuts[1:], len(starts)]):
                    run = table[owner[x]]
                    ids.append(None if run["none"] else int(run["doc"]))
                    texts.append(int(run["text_key"]))
                    found.append(starts[x:y].tobytes())
            yield pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "text_key": texts, "starts": found})

    return blocks.select("bucket", "task", "places").join(answers, ["bucket", "task"]).select("places", "answer").mapInPandas(
        resolve, "doc_id long, text_key long, starts binary"
    )


def kept_words(words, starts, width=WIDTH):
    """The words that no window of `starts` covers."""
    if not len(starts):
        return words
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    covered = np.cumsum(step[:-1]) > 0
    return [words[i] for i in np.flatnonzero(~covered)]


def marked(docs, width=WIDTH, gram=GRAM):
    """(row, marks): the rows of `docs` as structs, with the starts of their repeated windows as blocks, or null."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    base.ship(spark)
    sketch = base.stored(scan_sketch(docs, width, gram), "sketch")
    n_words = sketch.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(BUCKETS_AT_LEAST, n_words // BUCKET_WINDOWS)
    bits = spark.sparkContext.broadcast(repeated_cells(sketch))
    blocks = base.stored(scan_windows(docs, bits, buckets, width, gram), "windows")
    places = repeated_places(blocks, base.stored(repeated_keys(blocks), "answers"))
    marks = places.groupBy(F.col("doc_id").alias("m_doc"), F.col("text_key").alias("m_text")).agg(
        F.collect_list("starts").alias("marks")
    )
    keyed = rows.select("row", F.col("row.doc_id").alias("id"), F.xxhash64("row.text").alias("key"))
    met = keyed["id"].eqNullSafe(marks["m_doc"]) & (keyed["key"] == marks["m_text"])
    return keyed.join(marks, met, "left").select("row", "marks")


def _starts(marks):
    if marks is None or len(marks) == 0:
        return np.empty(0, np.int64)
    return np.frombuffer(b"".join(marks), np.uint32).astype(np.int64)


def removal_report(docs, width=WIDTH):
    """One row per document: doc_id, n_words, n_removed, kept_sha256 of the kept words joined by single spaces.

    `docs` needs doc_id and text. A null text has no words; a document shorter than the window keeps all of them. Copies
    and repeated rows repeat each other's windows, so they lose all words a window reaches. Ids may be null or repeated:
    marks belong to an id and a text. An empty table gives an empty result.
    """

    def finish(batches):
        for batch in batches:
            words, removed, digest = [], [], []
            for text, marks in zip(batch["text"], batch["marks"]):
                own = words_of(text)
                kept = kept_words(own, _starts(marks), width)
                words.append(len(own))
                removed.append(len(own) - len(kept))
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "n_words": words, "n_removed": removed, "kept_sha256": digest,
            })

    return marked(docs.select("doc_id", "text"), width).select("row.doc_id", "row.text", "marks").mapInPandas(
        finish, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def without_repeats(docs, width=WIDTH):
    """`docs` with all its columns, texts without the repeated passages; texts that lose nothing stay as they are.

    Where words go, the rest is joined by single spaces. A null text stays null. Cases as in `removal_report`.
    """
    @F.pandas_udf("string")
    def cleaned(text: pd.Series, marks: pd.Series) -> pd.Series:
        out = []
        for value, blocks in zip(text, marks):
            starts = _starts(blocks)
            out.append(b" ".join(kept_words(words_of(value), starts, width)).decode() if len(starts) else value)
        return pd.Series(out, dtype=object)

    kept = [
        cleaned("row.text", "marks").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns
    ]
    return marked(docs, width).select(*kept)
