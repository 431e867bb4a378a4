"""Evaluation items whose wording stands in corpus documents.

Every window of ``size`` words, of the items and of the documents, gets a 64-bit SimHash.  The
fingerprint is cut into ``radius + 1`` blocks, so two fingerprints within ``radius`` bits agree in
at least one block: joining on blocks finds all of them.  The windows of each candidate are then
compared exactly by their weighted five-word shingles.

The items are a query set against all documents.  While their windows number at most
``MAX_BROADCAST_WINDOWS`` the document side is thinned inside the scan by the blocks that occur
in items at all; beyond it the same blocks are joined by a shuffle.  Both give the same rows.

Defined results: NULL or short texts (fewer words than a window) give no row; repeated rows give
one row; NULL keys are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import spread

from .words import hash_words, shingle_hashes, window_prints, words_of

WINDOW = 13
RADIUS = 1
SHINGLE = 5
SIMILARITY = 0.8
#: 8 bytes each: 16 MB at most are sent to the tasks.
MAX_BROADCAST_WINDOWS = 2_000_000
#: Words fingerprinted at once in a task: 64 bytes of sums for each.
SLAB = 200_000
_TABLE_BITS = 22

WINDOWS = "key string, block_no int, block bigint, print bigint, words string"


def _blocks(prints: np.ndarray, radius: int) -> list[np.ndarray]:
    width = 64 // (radius + 1)
    return [((prints >> np.uint64(k * width)) & np.uint64((1 << width) - 1)).astype(np.int64) for k in range(radius + 1)]


class _Probe:
    """Which values of a block occur among the items."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.unique(values)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self._slot(self.values)] = True

    @staticmethod
    def _slot(values: np.ndarray) -> np.ndarray:
        return ((values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.table[self._slot(values)])
        place = np.minimum(np.searchsorted(self.values, values[at]), len(self.values) - 1)
        return at[self.values[place] == values[at]]


def _windows(size: int, radius: int, item_prints: np.ndarray | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        probes = None if item_prints is None else [_Probe(b) for b in _blocks(item_prints, radius)]

        def slab(keys: list[str], texts: list[list[str]]) -> pd.DataFrame:
            flat = [w for t in texts for w in t]
            owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
            prints = window_prints(hash_words(flat), size)
            inside = owner[: len(prints)] == owner[size - 1 :][: len(prints)]
            parts = []
            for no, values in enumerate(_blocks(prints, radius)):
                at = np.flatnonzero(inside) if probes is None else (hit := probes[no](values))[inside[hit]]
                if len(at):
                    _, first = np.unique(np.stack([owner[at], prints[at].view(np.int64)]), axis=1, return_index=True)
                    parts.extend((keys[owner[i]], no, int(values[i]), int(prints[i].view(np.int64)), " ".join(flat[i : i + size])) for i in at[first])
            return pd.DataFrame(parts, columns=["key", "block_no", "block", "print", "words"])

        for batch in batches:
            keys, texts, total = [], [], 0
            for key, text in zip(batch["key"], batch["text"], strict=True):
                if len(found := words_of(text)) >= size:
                    keys.append(key)
                    texts.append(found)
                    total += len(found)
                if total >= SLAB:
                    yield slab(keys, texts)
                    keys, texts, total = [], [], 0
            if keys:
                yield slab(keys, texts)

    return run


def weighted_similarity(a: Column, b: Column, shingle: int = SHINGLE) -> Column:
    """Weighted Jaccard of two windows: shingles count as often as they occur."""

    def shingles(words: Column) -> Column:
        parts = F.split(words, " ")
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - shingle + 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, i, shingle), " "))

    x, y = shingles(a), shingles(b)
    count = lambda array, s: F.size(F.filter(array, lambda e: e == s))
    either = F.array_union(x, y)
    low = F.aggregate(either, F.lit(0), lambda n, s: n + F.least(count(x, s), count(y, s)))
    high = F.aggregate(either, F.lit(0), lambda n, s: n + F.greatest(count(x, s), count(y, s)))
    return F.when(a == b, F.lit(1.0)).otherwise(low / high)


def leaked_windows(documents: DataFrame, items: DataFrame, *, size: int = WINDOW, radius: int = RADIUS, similarity: float = SIMILARITY, max_broadcast: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """``documents(key, text)`` against ``items(key, text)``: a row for each document, item and pair of windows that agree.

    Columns ``key, item, words, item_words, similarity``.
    """
    pick = lambda df: df.select(F.col("key").cast("string").alias("key"), "text").where("key is not null and text is not null")
    of_items = pick(items).mapInPandas(_windows(size, radius, None), WINDOWS)
    prints = of_items.select("print").distinct().limit(max_broadcast + 1).toPandas()["print"]
    if not len(prints):  # no item is long enough
        none = F.lit(None).cast("string")
        return pick(documents).limit(0).select("key", none.alias("item"), none.alias("words"), none.alias("item_words"), F.lit(0.0).alias("similarity"))
    known = prints.to_numpy(np.int64).view(np.uint64) if len(prints) <= max_broadcast else None
    of_documents = pick(documents).mapInPandas(_windows(size, radius, known), WINDOWS)
    right = of_items.select(F.col("key").alias("item"), "block_no", "block", F.col("print").alias("item_print"), F.col("words").alias("item_words"))
    pairs = of_documents.join(right, ["block_no", "block"]).where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
    pairs = pairs.select("key", "item", "words", "item_words").distinct()
    return pairs.withColumn("similarity", weighted_similarity(F.col("words"), F.col("item_words"))).where(F.col("similarity") >= similarity)


#: Near leaks: window sizes for short and long items, the step between windows of an item, and what an edit in ten words leaves.
NEAR_SIZES, STEP, NEAR_RADIUS, PAIR, NEAR_SIMILARITY = (16, 32), 8, 11, 2, 0.5
_BLOCKS, _BITS = 4, 16


class _Near:
    """All item fingerprints within ``NEAR_RADIUS`` bits of others, by multi-index hashing.

    Of four blocks one differs in at most ``NEAR_RADIUS // 4`` bits: each block is a table from a
    value to the items with a block so near.
    """

    def __init__(self, prints: np.ndarray) -> None:
        self.prints = prints
        masks = np.array([sum(1 << k for k in c) for n in range(NEAR_RADIUS // _BLOCKS + 1) for c in combinations(range(_BITS), n)], np.int64)
        self.tables = []
        for block in self._cut(prints):
            values = (block[:, None] ^ masks).ravel()
            order = np.argsort(values, kind="stable")
            self.tables.append((np.searchsorted(values[order], np.arange((1 << _BITS) + 1)), (order // len(masks)).astype(np.int32)))

    @staticmethod
    def _cut(prints: np.ndarray) -> list[np.ndarray]:
        return [(prints >> np.uint64(_BITS * k) & np.uint64((1 << _BITS) - 1)).astype(np.int64) for k in range(_BLOCKS)]

    def __call__(self, prints: np.ndarray) -> np.ndarray:
        """Rows of (position in ``prints``, item)."""
        found = []
        for (starts, items), block in zip(self.tables, self._cut(prints), strict=True):
            sizes = starts[block + 1] - starts[block]
            at = np.repeat(np.arange(len(prints)), sizes)
            item = items[np.repeat(starts[block] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())]
            near = np.bitwise_count(prints[at] ^ self.prints[item]) <= NEAR_RADIUS
            found.append(at[near] * len(self.prints) + item[near])
        return np.stack(np.divmod(np.unique(np.concatenate(found)), len(self.prints)), axis=1)


def _pairs(words: list[str]) -> Counter:
    return Counter(zip(*(words[k:] for k in range(PAIR)), strict=False))


#: Candidates whose word pairs are compared at once: a byte for each pair of pairs.
_AT_ONCE = 4_000


class _Alike:
    """Which windows can share enough word pairs with items; what cannot is refused by the similarity anyway."""

    def __init__(self, texts: list[str], size: int) -> None:
        self.length = size - PAIR + 1
        self.needed = int(np.ceil(2 * self.length * NEAR_SIMILARITY / (1 + NEAR_SIMILARITY) - 1e-9))
        self.of_items = np.array([shingle_hashes(hash_words(t.split(" ")), PAIR) for t in texts])
        self.known = np.unique(self.of_items)

    def begins(self, pairs: np.ndarray) -> np.ndarray:
        """Where the windows begin of which so many pairs occur in items."""
        place = np.minimum(np.searchsorted(self.known, pairs), len(self.known) - 1)
        count = np.concatenate([[0], np.cumsum(self.known[place] == pairs)])
        return np.flatnonzero(count[self.length :] - count[: -self.length] >= self.needed)

    def __call__(self, pairs: np.ndarray, begins: np.ndarray, items: np.ndarray) -> np.ndarray:
        """For each candidate, whether so many pairs of its window occur in its item, and of the item in the window."""
        kept = np.zeros(len(begins), bool)
        for k in range(0, len(begins), _AT_ONCE):
            mine = pairs[begins[k : k + _AT_ONCE, None] + np.arange(self.length)]
            same = mine[:, :, None] == self.of_items[items[k : k + _AT_ONCE]][:, None, :]
            kept[k : k + _AT_ONCE] = np.minimum(same.any(axis=2).sum(axis=1), same.any(axis=1).sum(axis=1)) >= self.needed
        return kept


def _near_windows(shared: Broadcast, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, texts, prints = shared.value
        index, alike, bags = _Near(prints), _Alike(texts, size), [_pairs(t.split(" ")) for t in texts]
        for batch in batches:
            rows: dict[tuple[str, str], float] = {}
            for key, text in zip(batch["key"], batch["text"], strict=True):
                words = words_of(text)
                for begin in range(0, max(len(words) - size + 1, 0), SLAB):
                    part = words[begin : begin + SLAB + size - 1]
                    hashes = hash_words(part)
                    pairs = shingle_hashes(hashes, PAIR)
                    if not len(starts := alike.begins(pairs)):
                        continue
                    near = index(window_prints(hashes, size)[starts])
                    where, which = starts[near[:, 0]], near[:, 1]
                    hit = alike(pairs, where, which)
                    for at, item in zip(where[hit], which[hit], strict=True):
                        mine = _pairs(part[at : at + size])
                        both = (mine & bags[item]).total()
                        similarity = both / (mine.total() + bags[item].total() - both)
                        if similarity >= NEAR_SIMILARITY and similarity > rows.get((key, items[item]), 0.0):
                            rows[key, items[item]] = similarity
            yield pd.DataFrame([(*k, v) for k, v in rows.items()], columns=["key", "item", "similarity"])

    return run


def _item_windows(size: int, longest: int | None):
    """Windows of the texts that have at least ``size`` words and fewer than ``longest``, ``STEP`` apart."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                words = words_of(text)
                if len(words) >= size and (longest is None or len(words) < longest):
                    prints = window_prints(hash_words(words), size).view(np.int64)
                    rows += [(key, " ".join(words[k : k + size]), int(prints[k])) for k in range(0, len(prints), STEP)]
            yield pd.DataFrame(rows, columns=["item", "words", "print"])

    return run


def near_leaks(documents: DataFrame, items: DataFrame, max_broadcast: int = 20_000) -> DataFrame:
    """``(key, item, similarity)``: documents that hold a window of an item with about one edit in ten words.

    Fingerprints within ``NEAR_RADIUS`` bits are found without loss; the weighted similarity of word pairs verifies.
    Items go to the tasks, ``max_broadcast`` windows at a time; more take further scans of the documents.
    """
    spark = documents.sparkSession
    pick = lambda df: df.select(F.col("key").cast("string").alias("key"), "text").where("key is not null and text is not null")
    found = pick(documents).limit(0).select("key", F.col("key").alias("item"), F.lit(0.0).alias("similarity"))
    texts = spread(pick(documents))
    for size, longest in zip(NEAR_SIZES, [*NEAR_SIZES[1:], None], strict=True):
        windows = pick(items).mapInPandas(_item_windows(size, longest), "item string, words string, print bigint").distinct()
        parts = -(-windows.count() // max_broadcast)
        for k in range(parts):
            part = windows.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == k).toPandas()
            shared = spark.sparkContext.broadcast((part["item"].tolist(), part["words"].tolist(), part["print"].to_numpy(np.int64).view(np.uint64)))
            found = found.unionByName(texts.mapInPandas(_near_windows(shared, size), "key string, item string, similarity double"))
    return found.groupBy("key", "item").agg(F.max("similarity").alias("similarity"))


def item_texts(eval_cases: DataFrame) -> DataFrame:
    """The question and the passage of each item, as texts of their own."""
    texts = F.explode(F.array("question", "passage"))
    return eval_cases.select(F.col("test_id").alias("key"), texts.alias("text"))


def leaked_items(documents: DataFrame, eval_cases: DataFrame) -> DataFrame:
    """``(doc_id, test_id)``: the document and the item share ``WINDOW`` consecutive words."""
    found = leaked_windows(documents.select(F.col("doc_id").alias("key"), "text"), item_texts(eval_cases))
    return found.where("words = item_words").select(F.col("key").cast("bigint").alias("doc_id"), F.col("item").alias("test_id")).distinct()
