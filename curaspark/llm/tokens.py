"""Byte-level BPE over whole texts; each merge comes from the root of a segment tree of pair ranks (problem 6)."""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from curaspark.session import spread

#: Where the public vocabulary files lie, unless a path is given.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
#: Pieces whose ids a worker keeps; least recently used ones go first.
CACHE = 1 << 19
#: Largest vocabulary file, in bytes.
MAX_VOCABULARY = 64 << 20
# Fixed value: how the public byte-level vocabularies cut a text into pieces before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_FAR = 1 << 62


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the content of a file with base64 tokens and ranks."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece by byte pair merges, lowest rank first, the leftmost of equal ranks.

    Leaf i of the segment tree holds rank and position of the pair that starts at part i, in one number whose order is
    that of the merges; the root is the next merge. A merge changes three leaves, so a piece of n bytes takes
    n log n steps however long it is.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    tree = [_FAR] * (2 * size)
    end = list(range(1, n + 1))  # of the part that starts here
    before = list(range(-1, n - 1))  # start of the part before
    get = ranks.get
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            tree[size + i] = r << 32 | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    while (root := tree[1]) < _FAR:
        i = root & 0xFFFFFFFF
        j = end[i]
        e = end[i] = end[j]
        if e < n:
            before[e] = i
            r = get(piece[i : end[e]])
            changed = [(i, _FAR if r is None else r << 32 | i), (j, _FAR)]
        else:
            changed = [(i, _FAR), (j, _FAR)]
        h = before[i]
        if h >= 0:
            r = get(piece[h:e])
            changed.append((h, _FAR if r is None else r << 32 | h))
        for at, value in changed:
            at += size
            if tree[at] == value:
                continue
            tree[at] = value
            at >>= 1
            while at:
                a, b = tree[2 * at], tree[2 * at + 1]
                low = a if a < b else b
                if tree[at] == low:
                    break
                tree[at] = low
                at >>= 1
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Texts to ids. Pieces repeat, so each is merged once while it stays in the cache."""

    def __init__(self, data: bytes, pattern: str = PATTERN):
        self.ranks = load_ranks(data)
        self.pieces = regex.compile(pattern).finditer
        self.piece = lru_cache(CACHE)(lambda p: tuple(merge_piece(p.encode("utf-8", "surrogatepass"), self.ranks)))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for an empty or null text."""
        out: list[int] = []
        if text:
            piece, add = self.piece, out.extend
            for m in self.pieces(text):
                add(piece(m.group()))
        return out


def vocabulary(name: str, folder: str | None = None) -> str:
    """Path of a vocabulary file in the driver; its content, some megabytes at most, is broadcast to the workers."""
    path = os.path.join(folder or TOKENIZERS, name)
    if not os.path.exists(path):
        spec = importlib.util.find_spec("public_tokenizers")
        path = os.path.join(os.path.dirname(spec.origin), name) if spec else path
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return path


def _content(path: str) -> bytes:
    if os.path.getsize(path) > MAX_VOCABULARY:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY} bytes")
    with open(path, "rb") as f:
        return f.read()


@lru_cache(2)
def _encoder_of(data: bytes) -> Encoder:
    """The encoder of a vocabulary; a worker keeps it, and so the pieces it has met, from task to task."""
    return Encoder(data)


def _encoder(path: str) -> Encoder:
    return _encoder_of(_content(path))


def encoded(df: DataFrame, row_id: str, text: str, path: str) -> DataFrame:
    """row_id, ids (array of int): the whole text by the byte-level BPE whose ranks lie at path, no special tokens.

    A null or empty text has the empty list; a blank one has the ids of its blanks. Repeated rows come out repeatedly. One narrow pass without
    shuffle; workers keep a table of the pieces they have met. Columns other than the two play no part.
    """

    shared = df.sparkSession.sparkContext.broadcast(_content(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder_of(shared.value).encode
        for b in batches:
            ids = [encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[row_id, "ids"])

    kind = dict(df.dtypes)[row_id]
    return spread(df.select(row_id, text)).mapInArrow(run, f"`{row_id}` {kind}, ids array<int>")


def token_counts(df: DataFrame, row_id: str, text: str, path: str) -> DataFrame:
    """row_id, n_tokens (int): the number of ids that encoded() gives, without sending them on."""

    shared = df.sparkSession.sparkContext.broadcast(_content(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder_of(shared.value).encode
        for b in batches:
            n = [len(encode(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32())], names=[row_id, "n_tokens"])

    kind = dict(df.dtypes)[row_id]
    return spread(df.select(row_id, text)).mapInArrow(run, f"`{row_id}` {kind}, n_tokens int")


def decoded(ids: pd.Series, path: str) -> pd.Series:
    """Texts of lists of ids; the inverse of encoded() for every text that is valid Unicode."""
    words = {r: w for w, r in _encoder(path).ranks.items()}
    return ids.map(lambda x: None if x is None else b"".join(words[i] for i in x).decode("utf-8", "replace"))
