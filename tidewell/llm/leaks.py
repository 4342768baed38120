"""Evaluation texts in a corpus, found by greedy string tiling."""

from __future__ import annotations

import heapq
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidewell.operators import skew
from tidewell.session import cut, spread

#: Items of up to so many characters in all go to every task as an index; more of them are joined to the corpus by their windows' fingerprints.
SMALL_ITEMS = 2_000_000
_INVISIBLE = regex.compile(r"[\p{Cf}\p{Mn}&&[͏︀-️]]|\p{Cf}", regex.V1)
_TAG = regex.compile(r"</?[A-Za-z][A-Za-z0-9]{0,9}(?:\s[^<>]{0,200})?/?>")
_CJK = r"\p{Han}\p{Hiragana}\p{Katakana}"
_WORD = regex.compile(rf"[{_CJK}]|[[\p{{L}}\p{{N}}\p{{M}}]--[{_CJK}]]+", regex.V1)
_CHAR = regex.compile(r"[\p{L}\p{N}]")
_HAS_CJK = regex.compile(rf"[{_CJK}]")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def level(text: str) -> str:
    """Text without the differences that don't count: markup tags, invisible characters, width, composition, case."""
    if text.isascii():
        return _TAG.sub("", text).lower() if "<" in text else text.lower()
    text = _INVISIBLE.sub("", text)
    if "<" in text:
        text = _TAG.sub("", text)
    return unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())


def words(text: str) -> list[str]:
    """Words of letters, digits and marks; a Chinese or Japanese character is a word of its own."""
    return _WORD.findall(text)


def chars(text: str) -> list[str]:
    """Letters and digits one by one."""
    return _CHAR.findall(text)


def by_chars(text: str, lang: str | None) -> bool:
    """Whether a text is measured in characters: zh and ja, and without a language, texts that are mostly in their scripts."""
    if lang:
        return lang.lower()[:2] in ("zh", "ja")
    c = chars(text)
    return 2 * sum(1 for x in c if _HAS_CJK.match(x)) > len(c)


def _rolling(ids: np.ndarray, m: int) -> np.ndarray:
    """Karp-Rabin fingerprint of each window of m ids, modulo 2^64."""
    n = len(ids) - m + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    for k in range(m):
        h = h * _BASE + mixed[k : k + n]
    return h


def tile(pairs: list[tuple[int, int]], m: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from seeds: (place in text, place in item, length) of non-overlapping matches, longest first.

    pairs: all places where m tokens of text and item agree. Seeds on one diagonal
    make a maximal match. The longest is marked; of a match that runs into marked
    tokens only the free stretches of m or more stay in play.
    """
    lines = defaultdict(list)
    for i, j in pairs:
        lines[i - j].append(i)
    queue = []
    for d, at in lines.items():
        at.sort()
        begin = prev = at[0]
        for i in at[1:] + [None]:
            if i is None or i != prev + 1:
                queue.append((-(prev - begin + m), begin, begin - d))
                begin = i
            prev = i
    heapq.heapify(queue)
    used_i, used_j, tiles = set(), set(), []
    while queue:
        n, i, j = heapq.heappop(queue)
        n = -n
        free = [i + k not in used_i and j + k not in used_j for k in range(n)]
        if all(free):
            tiles.append((i, j, n))
            used_i.update(range(i, i + n))
            used_j.update(range(j, j + n))
            continue
        k = 0
        while k < n:
            if free[k]:
                e = k
                while e < n and free[e]:
                    e += 1
                if e - k >= m:
                    heapq.heappush(queue, (-(e - k), i + k, j + k))
                k = e
            else:
                k += 1
    return tiles


class Index:
    """Seeds of the items measured in one way: window fingerprints, each with its places."""

    def __init__(self, items: list[tuple[int, list[str]]], m: int):
        self.m, self.vocabulary, self.items = m, {}, {}
        hashes, where = [], []
        for item, tokens in items:
            ids = np.array([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in tokens], np.int64)
            self.items[item] = ids
            h = _rolling(ids, m)
            hashes.append(h)
            where += [(item, j) for j in range(len(h))]
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes, self.where = h[order], [where[k] for k in order]

    def search(self, docs: list[list[str]]) -> Iterator[tuple[int, int, int]]:
        """(number of the doc, item, tokens covered) of each doc and item with a tile."""
        if not len(self.hashes):
            return
        get = self.vocabulary.get
        flat, starts = [], []
        for d in docs:
            starts.append(len(flat))
            flat += [get(t, -1) for t in d]
            flat.append(-1)
        ids = np.array(flat, np.int64)
        h = _rolling(ids, self.m)
        known = np.concatenate([[0], np.cumsum(ids < 0)])
        whole = known[self.m :] == known[: len(known) - self.m]
        at = np.flatnonzero(whole[: len(h)])
        left = np.searchsorted(self.hashes, h[at], "left")
        hit = (left < len(self.hashes)) & (self.hashes[np.minimum(left, len(self.hashes) - 1)] == h[at])
        at, left = at[hit], left[hit]
        if not len(at):
            return
        doc = np.searchsorted(starts, at, "right") - 1
        seeds: dict[tuple[int, int], list] = defaultdict(list)
        for d, i, k in zip(doc.tolist(), at.tolist(), left.tolist()):
            while k < len(self.hashes) and self.hashes[k] == h[i]:
                item, j = self.where[k]
                if (ids[i : i + self.m] == self.items[item][j : j + self.m]).all():  # a fingerprint proves nothing
                    seeds[d, item].append((i, j))
                k += 1
        for (d, item), pairs in seeds.items():
            yield d, item, sum(n for _, _, n in tile(pairs, self.m))


def _hashed(tokens: list[str], m: int) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of each window of m tokens: Karp-Rabin over the tokens' hashes, and over those in another order of bits; together 128 bits."""
    ids = np.array([xxh64_intdigest(t) for t in tokens], np.uint64)
    return _rolling(ids, m).view(np.int64), _rolling(ids * np.uint64(0xC2B2AE3D27D4EB4F) ^ (ids >> np.uint64(29)), m).view(np.int64)


def _by_windows(rows: DataFrame, items: DataFrame, kinds: tuple[str, str], measures: tuple, share: float) -> DataFrame:
    """(key, item, covered, size) by a join of window fingerprints, for items of any number.

    items: (item, text, lang). Only windows whose fingerprint an item has too leave the join with places; those of one document and item
    are tiled together. Fingerprints that many documents or items share (boilerplate) are split over tasks by skew.balanced_join.
    """

    def item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, at, sizes, kind, h, g = [], [], [], [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for d, (t, lang) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                t = level(t)
                for n, (m, cut_up, mine) in enumerate(measures):
                    if by_chars(t, lang) == mine:
                        tokens = cut_up(t)
                        x, y = _hashed(tokens, m)
                        h.append(x)
                        g.append(y)
                        who += [d] * len(x)
                        at += range(len(x))
                        sizes += [len(tokens)] * len(x)
                        kind += [n] * len(x)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(who, pa.int64())), pa.array(kind, pa.int32()), pa.array(np.concatenate(h)), pa.array(np.concatenate(g)), pa.array(at, pa.int32()), pa.array(sizes, pa.int32())], ["item", "kind", "h", "g", "j", "size"])

    def doc_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, t in enumerate(b.column(1)):
                t = level(t.as_py())
                for n, (m, cut_up, mine) in enumerate(measures):
                    if mine and not _HAS_CJK.search(t):
                        continue
                    x, y = _hashed(cut_up(t), m)
                    for low in range(0, len(x), 100_000):
                        h = x[low : low + 100_000]
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.full(len(h), d))), b.column(2).take(pa.array(np.full(len(h), d))), pa.array(np.full(len(h), n, np.int32)), pa.array(h), pa.array(y[low : low + 100_000]), pa.array(np.arange(low, low + len(h), dtype=np.int32))], ["key", "doc", "kind", "h", "g", "i"])

    theirs = cut(items.mapInArrow(item_windows, f"item {kinds[1]}, kind int, h long, g long, j int, size int"), "item-windows")
    mine = rows.withColumn("doc", F.monotonically_increasing_id()).mapInArrow(doc_windows, f"key {kinds[0]}, doc long, kind int, h long, g long, i int")
    # most windows of a corpus are in no item: they go at the first join, which carries no places
    known = theirs.select("kind", "h", "g").distinct()
    hits = cut(mine.join(known, ["kind", "h", "g"], "left_semi"), "doc-windows")
    seeds = skew.balanced_join(hits, theirs, skew.plan_load(hits, "h"), "doc", "inner").where("kind = kind_match and g = g_match")

    def tiled(pdf):
        import pandas as pd

        m = measures[int(pdf["kind"].iloc[0])][0]
        n = sum(k for _, _, k in tile(list(zip(pdf["i"].tolist(), pdf["j"].tolist())), m))
        size = int(pdf["size"].iloc[0])
        return pd.DataFrame([(pdf["key"].iloc[0], pdf["item"].iloc[0], n, size)] if n >= share * size else [], columns=["key", "item", "covered", "size"])

    return seeds.groupBy("doc", "item").applyInPandas(tiled, f"key {kinds[0]}, item {kinds[1]}, covered int, size int")


def find_leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str, item_lang: str, least_words: int = 5, least_chars: int = 10, share: float = 0.5) -> DataFrame:
    """(key, item, covered, size): documents that hold at least `share` of an item's wording in unbroken stretches of
    least_words or more words (zh, ja: least_chars letters and digits).

    Null and empty texts leak nothing; an item shorter than a stretch can't be found. A document row that repeats gives
    one row; an item's id is unique. Texts are searched whole, of any length.

    Token seeds shared with an item are found by rolling fingerprints against the
    index of all items' windows; tiles are then marked greedily, longest first,
    which also catches passages in another order. Items of up to SMALL_ITEMS characters go to the tasks as an index, for one pass
    over the corpus without a shuffle of its texts. More of them are a table of windows that the corpus's windows are joined to, so neither the driver nor a task holds them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("key is not null and text is not null and text <> ''")
    rows = spread(rows, "key", "text")
    kinds = rows.schema["key"].dataType.simpleString(), items.schema[item].dataType.simpleString()
    schema = f"key {kinds[0]}, item {kinds[1]}, covered int, size int"

    known = items.select(F.col(item).alias("item"), F.col(item_text).alias("text"), F.col(item_lang).alias("lang")).where("item is not null and text is not null")
    measures = ((least_words, words, False), (least_chars, chars, True))
    if known.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] <= SMALL_ITEMS:
        sent = spark.sparkContext.broadcast([tuple(r) for r in known.collect()])
        ready: list = []

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not ready:
                texts = [(i, level(t), lang) for i, t, lang in sent.value]
                for m, cut_up, mine in measures:
                    ready.append((Index([(i, cut_up(t)) for i, t, lang in texts if by_chars(t, lang) == mine], m), cut_up, mine))
            for b in batches:
                names, found = b.column(0), []
                todo, size = [], 0
                for d in range(b.num_rows):
                    todo.append((d, level(b.column(1)[d].as_py())))
                    size += len(todo[-1][1])
                    if size < 2_000_000 and d < b.num_rows - 1:
                        continue
                    for index, cut_up, mine in ready:
                        some = [(n, t) for n, t in todo if not mine or _HAS_CJK.search(t)]
                        for n, it, covered in index.search([cut_up(t) for _, t in some]):
                            total = len(index.items[it])
                            if covered >= share * total:
                                found.append((some[n][0], it, covered, total))
                    todo, size = [], 0
                if found:
                    d, it, covered, total = zip(*found)
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(d)), pa.array(it), pa.array(covered, pa.int32()), pa.array(total, pa.int32())], ["key", "item", "covered", "size"])

        out = rows.mapInArrow(run, schema)
    else:
        out = _by_windows(rows, known, kinds, measures, share)
    best = out.groupBy("key", "item").agg(F.max("covered").alias("covered"), F.max("size").alias("size"))
    return best.select(F.col("key").alias(key), F.col("item").alias(item), "covered", "size")
