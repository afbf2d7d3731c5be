"""Cutting texts for byte-level BPE where a cut can't fall inside a match of the pattern, and remembering parts."""

import base64
import re
from array import array

import numpy as np
import regex

# Bytes that a Python worker spends on remembering parts of texts, and on which longer parts it spends none.
REMEMBERED_BYTES = 192 << 20
LONGEST_PART = 256
# What an entry takes besides its text and ids: two objects and its place in the table, about.
ENTRY_BYTES = 190

_SPACE_RUN = re.compile(r"\s\s")


def load_ranks(path):
    """Token bytes to rank, of a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def parts_of(text):
    """Parts of a text, cut before single spaces and around single line feeds; None if it can't be cut so.

    The pattern takes one space together with what follows, and one line feed between other characters by itself, so no
    match crosses these cuts. Runs of white space are matched as a whole; texts that hold any are not cut.
    """
    if "\0" in text or _SPACE_RUN.search(text):
        return None
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


class TwoGenerations(dict):
    """A memory of bounded size: beyond half of it the entries become the old ones, and the old ones go."""

    def __init__(self, most):
        super().__init__()
        self.most, self.held, self.old = most, 0, {}

    def keep(self, key, value, cost=1):
        """Remember an entry of this cost."""
        if 2 * (self.held + cost) > self.most:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += cost
        self[key] = value
        return value


class Remembering(TwoGenerations):
    """Ids of text parts, as bytes of 32-bit numbers, made by `encode` when first asked for; `most` is in bytes.

    Parts of more than LONGEST_PART characters, such as whole texts of scripts without spaces, are not remembered. Texts that
    can't be cut go to `whole` (by default `encode`).
    """

    def __init__(self, encode, most=REMEMBERED_BYTES, whole=None):
        super().__init__(most)
        self.encode, self.whole = encode, whole or encode

    def __missing__(self, part):
        ids = self.old.get(part)
        if ids is None:
            ids = array("I", self.encode(part)).tobytes() if part else b""
        if len(part) > LONGEST_PART:
            return ids
        return self.keep(part, ids, ENTRY_BYTES + len(part) + len(ids))

    def ids(self, text):
        """Ids of a whole text; null is the empty text."""
        parts = parts_of(text) if text else []
        if parts is None:
            return np.asarray(self.whole(text), "<u4")
        return np.frombuffer(b"".join(map(self.__getitem__, parts)), "<u4")


def pattern(source):
    return regex.compile(source)
