"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is exactly one token that its encoding ends with: the token t for which the encoding
of the prefix before t, followed by t, is again an encoding. That holds exactly if t goes with the token before it, i.e.
if encoding both their bytes gives back the two. Storing this last token per prefix gives the encoding by walking back;
appending bytes only adds entries, and after an edit only pieces near it are encoded anew.
"""

import hashlib
import math

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from tallyhouse.llm import base
from tallyhouse.llm.tokens import REMEMBERED_BYTES, Remembering, TwoGenerations, load_ranks, pattern

# Code points that a match may have looked at beyond its end; an edit re-encodes from the last match clear of it.
LOOK_AHEAD = 3
# Pairs of tokens of which a Python worker remembers whether they go together; about 130 bytes each.
REMEMBERED_PAIRS = 1_000_000
# Documents that are encoded before their rows are given on.
ROWS_AT_ONCE = 256


def merged_by_rank(piece, ranks):
    """Plain BPE: join the adjacent pair of lowest rank until none is left. Used for pairs of tokens, which are short."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    ranked = [ranks.get(x + y, math.inf) for x, y in zip(parts, parts[1:])]
    while ranked and (low := min(ranked)) < math.inf:
        at = ranked.index(low)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del ranked[at]
        for pair in range(max(0, at - 1), min(at + 1, len(ranked))):
            ranked[pair] = ranks.get(parts[pair] + parts[pair + 1], math.inf)
    return [ranks[p] for p in parts]


class Fitting(TwoGenerations):
    """Whether a token may follow another (-1: begin a piece), by their ranks put into one number."""

    def __init__(self, ranks, tokens, most):
        super().__init__(most)
        self.ranks, self.tokens = ranks, tokens
        self.shift = len(tokens).bit_length()

    def __missing__(self, key):
        known = self.old.get(key)
        if known is None:
            before, token = key >> self.shift, key & (1 << self.shift) - 1
            first = [] if before < 0 else [before]
            piece = b"".join(self.tokens[t] for t in [*first, token])
            known = merged_by_rank(piece, self.ranks) == [*first, token]
        return self.keep(key, known)


class Vocabulary:
    """Ranks with what the dynamic program asks of them; `most_pairs` bounds its memory of pairs."""

    def __init__(self, ranks, source, most_pairs=REMEMBERED_PAIRS):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks))
        # Finds the tokens that end at each byte; a byte is given as the letter of its number.
        self.matcher = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.matcher.add_word(token.decode("latin-1"), (rank, len(token)))
        self.matcher.make_automaton()
        self.pattern = pattern(source)
        self.fitting = Fitting(ranks, self.tokens, most_pairs)

    def fits(self, before, token):
        """Whether `token` may follow `before` (-1: begin a piece)."""
        return self.fitting[before << self.fitting.shift | token]

    def extend(self, piece, last):
        """Add the last tokens of the prefixes of `piece` that `last` (one entry per prefix so far) doesn't have yet."""
        fitting, shift, begin = self.fitting, self.fitting.shift, max(0, len(last) + 1 - self.longest)
        for end, (token, size) in self.matcher.iter(piece[begin:].decode("latin-1")):
            end += begin
            if end < len(last):
                continue
            if end > len(last):
                break
            before = last[end - size] if end >= size else -1
            if fitting[before << shift | token]:
                last.append(token)
        if len(last) < len(piece):
            raise ValueError("the vocabulary lacks a single byte")

    def walk(self, last):
        """Tokens of a piece from the last tokens of its prefixes."""
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.tokens[out[-1]])
        return out[::-1]

    def encode_piece(self, piece):
        """Tokens of one match of the pattern; a piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last = []
        self.extend(piece, last)
        return self.walk(last)

    def encode(self, text):
        return [t for match in self.pattern.finditer(text) for t in self.encode_piece(match.group().encode())]

    def decode(self, ids):
        return b"".join(map(self.tokens.__getitem__, ids))


class Prefixes:
    """A growing piece: `append` costs only the new bytes and is exact."""

    def __init__(self, vocabulary, piece=b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", []
        self.append(piece)

    def append(self, more):
        self.piece += more
        self.vocabulary.extend(self.piece, self.last)

    def tokens(self):
        whole = self.vocabulary.ranks.get(self.piece)
        return [whole] if whole is not None else self.vocabulary.walk(self.last)


class Encoded:
    """A text with its tokens by match of the pattern; appends and edits re-encode only matches near them."""

    def __init__(self, vocabulary, text=""):
        self.vocabulary, self.text = vocabulary, text
        self.starts, self.parts = [], []
        self.worked = 0
        self._match(0, None, 0)

    def _match(self, start, resume, shift):
        """Match from `start`; stop where a match begins at the start of an old one in `resume` (moved by `shift`)."""
        starts, parts = [], []
        for match in self.vocabulary.pattern.finditer(self.text, start):
            if resume is not None and match.start() - shift in resume:
                at = resume[match.start() - shift]
                starts += [s + shift for s in self.old_starts[at:]]
                parts += self.old_parts[at:]
                break
            starts.append(match.start())
            parts.append(self.vocabulary.encode_piece(match.group().encode()))
            self.worked += 1
        self.starts += starts
        self.parts += parts

    def replace(self, start, stop, new):
        """Put `new` in place of text[start:stop]."""
        ends = self.starts[1:] + [len(self.text)]
        keep = sum(1 for end in ends[: len(self.starts)] if end + LOOK_AHEAD <= start)
        again = self.starts[keep] if keep < len(self.starts) else len(self.text)
        self.old_starts, self.old_parts = self.starts, self.parts
        shift = len(new) - (stop - start)
        resume = {s: i for i, s in enumerate(self.starts) if s >= stop and i >= keep}
        self.text = self.text[:start] + new + self.text[stop:]
        self.starts, self.parts, self.worked = self.starts[:keep], self.parts[:keep], 0
        self._match(again, resume, shift)

    def append(self, more):
        self.replace(len(self.text), len(self.text), more)

    def tokens(self):
        return [t for part in self.parts for t in part]


_VOCABULARIES = {}


def vocabulary(path, source, most_bytes=REMEMBERED_BYTES, most_pairs=REMEMBERED_PAIRS):
    """The vocabulary of a rank file with its memory of parts, kept per Python process; the last bounds given hold."""
    key = (path, source)
    if key not in _VOCABULARIES:
        words = Vocabulary(load_ranks(path), source, most_pairs)
        _VOCABULARIES[key] = words, Remembering(words.encode, most_bytes)
    words, memory = _VOCABULARIES[key]
    words.fitting.most, memory.most = most_pairs, most_bytes
    return words, memory


def round_trip(docs, path, source):
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    `path` names the rank file, which every executor must have; `source` is the pattern. A null text is the empty text:
    no tokens, digests of nothing. Any Unicode text is encoded in full and decodes to its own bytes. Ids may be null or
    repeated: rows are independent. An empty table gives an empty result.
    """
    base.ship(docs.sparkSession)

    def scan(batches):
        words, memory = vocabulary(path, source)
        names = [str(i) for i in range(len(words.tokens))]
        for batch in batches:
            counts, ids_digest, text_digest = [], [], []
            for text in batch["text"]:
                ids = memory.ids(text).tolist()
                counts.append(len(ids))
                ids_digest.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                text_digest.append(hashlib.sha256(words.decode(ids)).hexdigest())
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "n_tokens": counts,
                "ids_sha256": ids_digest, "decoded_sha256": text_digest,
            })

    return docs.select("doc_id", "text").mapInPandas(
        scan, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def with_tokens(docs, path, source, most_bytes=REMEMBERED_BYTES, most_pairs=REMEMBERED_PAIRS):
    """`docs` with its text replaced by n_tokens (long), token_ids (array<int>) and round_trip (whether they decode to it).

    One function gives all three, a few hundred documents at a time, so that a task holds little besides its batch of texts;
    the last two parameters bound what it remembers. Other columns pass as they are, in order, the new ones at the end. A
    null text is the empty text: no tokens, and nothing decodes to it. Rows are independent; an empty table stays empty.
    """
    base.ship(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("text", "n_tokens", "token_ids", "round_trip")]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], "text")
    schema = StructType([rows.schema[c] for c in others]).add("n_tokens", "long").add("token_ids", ArrayType(IntegerType())).add("round_trip", "boolean")

    def encode(batches):
        base.release_memory()
        words, memory = vocabulary(path, source, most_bytes, most_pairs)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                ids, equal = [], []
                for text in batch.column(len(others)).to_pylist():
                    ids.append(memory.ids(text).astype(np.int32))
                    equal.append(words.decode(ids[-1].tolist()) == (text or "").encode())
                counts = np.array([len(i) for i in ids], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(np.concatenate(ids)))
                columns = [batch.column(i) for i in range(len(others))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts), lists, pa.array(equal)], names=schema.names)

    return rows.mapInArrow(encode, schema)


def encoder(spark, path, source):
    """A function of a text column that gives its ids; null is the empty text."""
    base.ship(spark)

    @F.pandas_udf("array<int>")
    def encoded(text: pd.Series) -> pd.Series:
        _, memory = vocabulary(path, source)
        return pd.Series([memory.ids(value).astype(np.int32) for value in text], dtype=object)

    return encoded


def decoder(spark, path, source):
    """A function of a column of ids that gives the bytes they stand for; null stays null."""
    base.ship(spark)

    @F.pandas_udf("binary")
    def decoded(ids: pd.Series) -> pd.Series:
        words, _ = vocabulary(path, source)
        return pd.Series([None if value is None else words.decode(value.tolist()) for value in ids], dtype=object)

    return decoded
