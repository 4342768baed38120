"""Encoding with a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import spread

VOCABULARY = os.path.join(os.environ.get("TIDEWELL_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")
# Fixed value: the public pattern that cuts a text into words for this vocabulary (\s spelled out as the property).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Words of more bytes are merged with a heap, as scanning them again and again would take quadratic time.
SHORT = 256
#: Words kept with their ids in a worker.
CACHE = 300_000
_NONE = 1 << 30


class Encoder:
    """ids of texts; special tokens' strings are ordinary text."""

    def __init__(self, path: str = VOCABULARY, content: bytes | None = None):
        if content is None:
            with open(path, "rb") as f:
                content = f.read()
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.words = regex.compile(PATTERN)
        self.known: dict[str, list[int]] = {}

    def merge_short(self, word: bytes) -> list[int]:
        """Contiguous rank array: boundaries and the rank of each pair of neighbours lie in two lists. The
        leftmost smallest rank is found by a scan, its boundary deleted, and the two pairs beside it looked up again."""
        rank = self.ranks.get
        n = len(word)
        if n == 1:
            return [self.ranks[word]]
        bound = list(range(n + 1))
        ranks = [rank(word[i : i + 2], _NONE) for i in range(n - 1)]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            del bound[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(word[bound[i] : bound[i + 2]], _NONE)
            if i:
                ranks[i - 1] = rank(word[bound[i - 1] : bound[i + 1]], _NONE)
        return [self.ranks[word[a:b]] for a, b in zip(bound, bound[1:])]

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges, the smallest rank taken from a heap; for words of any length."""
        rank, n = self.ranks.get, len(word)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i : i + 2], _NONE)) != _NONE]
        heapq.heapify(heap)

        def look(i: int) -> None:
            if i >= 0 and nxt[i] < n and (r := rank(word[i : nxt[nxt[i]]], _NONE)) != _NONE:
                heapq.heappush(heap, (r, i, nxt[nxt[i]]))

        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or nxt[i] >= n or nxt[nxt[i]] != end:
                continue  # one of the two parts has changed since
            j = nxt[i]
            alive[j] = False
            nxt[i] = end
            if end < n:
                prev[end] = i
            look(i)
            look(prev[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i : nxt[i]]])
            i = nxt[i]
        return out

    def encode(self, text: str | None) -> list[int]:
        """[] for null and empty texts."""
        if not text:
            return []
        out: list[int] = []
        known = self.known
        for w in self.words.findall(text):
            ids = known.get(w)
            if ids is None:
                b = w.encode("utf-8", "replace")
                if (whole := self.ranks.get(b)) is not None:
                    ids = [whole]
                else:
                    ids = self.merge_short(b) if len(b) <= SHORT else self.merge_long(b)
                if len(w) <= 64:
                    if len(known) >= CACHE:
                        known.clear()
                    known[w] = ids
            out += ids
        return out


@lru_cache(maxsize=2)
def _encoder(content: bytes) -> Encoder:
    """One for each worker process."""
    return Encoder(content=content)


def encode_texts(docs: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """(key, ids array<int>): one row for each row of docs, without special tokens; [] for null and empty texts.

    White-space and symbol texts get their ids like any other. Rows keep their number, order and repeats; other columns are ignored.
    Each partition is encoded where it is read, with a cache of words; only a table of a few MB is spread first (see session.spread).
    The vocabulary file is read by the driver and goes to the tasks with the job, so executors need no copy of it; its size doesn't depend on the data.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = spread(rows, "key", "text")
    with open(path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(sent.value)
        for b in batches:
            flat, ends = [], [0]
            for t in b.column(1):
                flat += e.encode(t.as_py())
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(flat, np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["key", "ids"])

    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)
