"""Byte-level BPE encoding of whole texts with a public rank file.

A text is split by the tokenizer's pattern; each piece starts as single bytes, and the
adjacent pair of lowest rank, leftmost first, is merged until no pair has a rank. A
segment tree over the byte positions keeps the leftmost pair of least rank: its root is
the next merge, and a merge changes at most three leaves, each in logarithmic time, so
a piece of n bytes takes O(n log n) however it merges.

Defined results: null and empty texts give an empty list (count 0); strings that look
like special tokens are ordinary text; a repeated row is encoded each time; a text of any
length is encoded whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the vocabularies lie; a parameter of every function.
FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The pattern that belongs to the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = 1 << 30
#: Distinct pieces a worker remembers; more are encoded again.
REMEMBERED = 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    size = 1
    while size < n:
        size *= 2
    tree = [NONE] * (2 * size)  # the least rank below each node; leaf i is the pair that starts at i
    end = list(range(1, n + 1))  # where the token that starts at i ends
    before = list(range(-1, n - 1))  # start of the live token before
    for i in range(n - 1):
        tree[size + i] = ranks.get(piece[i : i + 2], NONE)
    for x in range(size - 1, 0, -1):
        tree[x] = min(tree[2 * x], tree[2 * x + 1])

    def put(i: int, rank: int) -> None:
        x = size + i
        tree[x] = rank
        x >>= 1
        while x:
            a, b = tree[2 * x], tree[2 * x + 1]
            low = a if a <= b else b
            if tree[x] == low:
                return
            tree[x] = low
            x >>= 1

    def pair(i: int) -> int:
        j = end[i]
        return ranks.get(piece[i : end[j]], NONE) if j < n else NONE

    while (best := tree[1]) != NONE:
        x = 1
        while x < size:  # the left child first: leftmost of equals
            x = 2 * x if tree[2 * x] == best else 2 * x + 1
        i = x - size
        j = end[i]
        end[i] = end[j]
        if end[j] < n:
            before[end[j]] = i
        put(j, NONE)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder(dict):
    """Pieces that were seen, with their ids; a missing one is encoded."""

    def __init__(self, path: str, pattern: str = PATTERN):
        super().__init__()
        self.ranks, self.split = load_ranks(path), regex.compile(pattern).findall

    def __missing__(self, piece: str) -> list[int]:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = merge_piece(piece.encode("utf-8"), self.ranks)
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        return [i for p in self.split(text) for i in self[p]] if text else []

    def count(self, text: str | None) -> int:
        return sum(len(self[p]) for p in self.split(text)) if text else 0


def token_ids(text: Column, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> Column:
    """ARRAY<INT>: the ids of each text."""

    @F.pandas_udf("array<int>")
    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = Encoder(f"{folder}/{vocabulary}")
        for s in parts:
            yield s.map(e.encode)

    return ids(text)


def token_count(text: Column, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> Column:
    """INT: the number of ids of each text, without making the lists."""

    @F.pandas_udf("int")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = Encoder(f"{folder}/{vocabulary}")
        for s in parts:
            yield s.map(e.count).astype("int32")

    return count(text)
