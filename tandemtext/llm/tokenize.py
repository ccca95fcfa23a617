"""Encoding of whole texts with a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pre-tokenisation pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = 1 << 30


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def bpe(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token.

    The leaves of a segment tree hold the ranks of adjacent pairs; its root
    holds the lowest one, the leftmost among equals. Each merge changes three
    leaves, each in a logarithmic update, until the root holds no mergeable pair.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    part: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    size = 1
    while size < n:
        size *= 2
    tree = [(NONE, i - size) for i in range(2 * size)]
    for i in range(n - 1):
        tree[size + i] = (ranks.get(piece[i : i + 2], NONE), i)
    for k in range(size - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, rank: int) -> None:
        k = size + i
        tree[k] = (rank, i)
        k //= 2
        while k:
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
            k //= 2

    while tree[1][0] < NONE:
        i = tree[1][1]
        j = after[i]
        part[i] += part[j]
        part[j] = None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
            put(i, ranks.get(part[i] + part[after[i]], NONE))
        else:
            put(i, NONE)
        put(j, NONE)
        if before[i] >= 0:
            put(before[i], ranks.get(part[before[i]] + part[i], NONE))
    return [ranks[p] for p in part if p is not None]


class Chunks(dict):
    """Ids of a blank-led chunk, computed once per distinct chunk and worker; emptied at ``limit`` chunks."""

    def __init__(self, ranks: dict[bytes, int], limit: int = 500_000):
        super().__init__()
        self.ranks, self.limit, self.find = ranks, limit, regex.compile(PATTERN).findall

    def __missing__(self, chunk: str) -> list[int]:
        ids = [i for piece in self.find(chunk) for i in bpe(piece.encode("utf-8"), self.ranks)]
        if len(chunk) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[chunk] = ids
        return ids


def chunks(text: str) -> list[str]:
    """Cut a text before each blank that a visible character follows.

    The pattern always starts a pre-token there, so chunks can be encoded one
    by one. A blank before further white space stays inside its chunk.
    """
    parts = text.split(" ")
    if "" not in parts and not any(p[0].isspace() for p in parts):
        return [parts[0], *[" " + p for p in parts[1:]]]
    out = [parts[0]]
    for p in parts[1:]:
        if p and not p[0].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out


def encode(text: str | None, memo: Chunks) -> list[int]:
    """Ids without special tokens; null and empty texts have none."""
    return [i for c in chunks(text) for i in memo[c]] if text else []


_MEMO: dict[int, Chunks] = {}


def token_ids(spark: SparkSession, df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids) of each row: the whole text as it stands, whatever its length.

    A narrow pass of Arrow batches without a shuffle. The vocabulary (its file
    has a fixed size of under 1 MB) is read on the driver and broadcast; a
    worker keeps the ids of chunks it has met, so that each distinct chunk is
    merged once. Null and empty texts get an empty list; repeated rows and null
    keys are kept as they are.
    """
    shared = spark.sparkContext.broadcast(load_ranks(vocabulary))
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _MEMO.get(id(shared.value))
        if memo is None:
            _MEMO.clear()
            memo = _MEMO[id(shared.value)] = Chunks(shared.value)
        for batch in batches:
            ids: list[int] = []
            offsets = [0]
            for value in batch.column(1).to_pylist():
                if value:
                    for c in chunks(value):
                        ids += memo[c]
                offsets.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(np.array(offsets, dtype=np.int32)), pa.array(np.array(ids, dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "ids"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {key_type}, ids array<int>")
