"""Benchmark items found in documents by SimHash of item-sized windows.

Every window as long as an item and sharing a shingle with it gets a fingerprint; a document
shorter than the item is one window. A multi-index
finds all item fingerprints within the radius: the 64 bits are cut into blocks, and if two
fingerprints are within the radius, some block differs in so few bits that trying these few
changes must hit. Each candidate is then compared by the weighted Jaccard similarity of shingles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import workers_find_package
from larder.llm.words import run_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: Items at the similarity differ in about 10 of 64 bits, with a deviation of 3.
RADIUS = 23
_BLOCKS, _BITS = 8, 8
_SCHEMA = "item_id long, similarity double, start_word long, n_words long"


def words_of(text: str | None) -> np.ndarray:
    """Hashes of the words between ASCII white space, A-Z in lower case."""
    return word_hashes(text.encode().lower().split() if text else [])


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def window_fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of ``size`` shingle hashes, by prefix sums of their bits."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(_bits(hashes), axis=0, dtype=np.int32, out=sums[1:])
    over = (sums[size:] - sums[:n]) * 2 > size
    return np.packbits(over, axis=1, bitorder="little").view("<u8")[:, 0].astype(np.uint64)


def weighted_jaccard(a: Counter, b: Counter) -> float:
    """Shared weight over joint weight, a shingle weighing as often as it stands there."""
    shared = (a & b).total()
    return shared / (a.total() + b.total() - shared) if shared else 0.0


class Items:
    """A block of benchmark items: shingles, fingerprints and the multi-index over them."""

    def __init__(self, items: list[tuple[int, np.ndarray]], radius: int = RADIUS):
        self.ids = [item_id for item_id, _ in items]
        self.sizes = np.array([len(w) for _, w in items], np.int64)
        self.radius = radius
        self.grams = [min(SHINGLE, n) for n in self.sizes]
        hashes = [run_hashes(w, g) for (_, w), g in zip(items, self.grams)]
        self.weights = [Counter(h.tolist()) for h in hashes]
        self.prints = np.array([int(window_fingerprints(h, len(h))[0]) for h in hashes], np.uint64)
        #: for each shingle size: sorted shingle hashes and the items that have each
        self.shingles = {}
        for gram in sorted(set(self.grams)):
            own = [(h, i) for i, g in enumerate(self.grams) if g == gram for h in self.weights[i]]
            keys = np.array([h for h, _ in own], np.uint64)
            order = np.argsort(keys, kind="stable")
            self.shingles[gram] = keys[order], np.array([i for _, i in own], np.int64)[order]
        tries = radius // _BLOCKS
        flips = [sum(1 << b for b in c) for k in range(tries + 1) for c in combinations(range(_BITS), k)]
        parts = self.prints.astype("<u8").view(np.uint8).reshape(-1, _BLOCKS)
        #: for each block and value: the items whose block differs from it in at most ``tries`` bits
        self.index = []
        for b in range(_BLOCKS):
            values = (parts[:, b][:, None] ^ np.array(flips, np.uint8)).ravel()
            items = np.repeat(np.arange(len(parts), dtype=np.int32), len(flips))
            starts = np.searchsorted(np.sort(values), np.arange((1 << _BITS) + 1))
            self.index.append((starts, items[np.argsort(values, kind="stable")]))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (place in ``prints``, item) within the radius."""
        parts = prints.astype("<u8").view(np.uint8).reshape(-1, _BLOCKS)
        pairs = []
        for b, (starts, items) in enumerate(self.index):
            first = starts[parts[:, b]]
            counts = starts[parts[:, b].astype(np.int64) + 1] - first
            places = np.repeat(np.arange(len(prints)), counts)
            within = np.arange(len(places)) - np.repeat(np.cumsum(counts) - counts, counts)
            found = items[np.repeat(first, counts) + within]
            apart = np.bitwise_count(prints[places] ^ self.prints[found])
            pairs.append(places[apart <= self.radius] * len(self.ids) + found[apart <= self.radius])
        return np.divmod(np.unique(np.concatenate(pairs)), len(self.ids))

    def matches(self, words: np.ndarray, least: float) -> Iterator[tuple[int, float, int, int]]:
        """The best window of each item: item, similarity, first word and number of words. Of
        equally similar windows the first."""
        best: dict[int, tuple[float, int]] = {}
        for gram, (keys, owners) in self.shingles.items():
            hashes = run_hashes(words, gram)
            if not len(hashes):
                continue
            left, right = np.searchsorted(keys, hashes), np.searchsorted(keys, hashes, side="right")
            hits = np.flatnonzero(right > left)
            if not len(hits):
                continue
            by_item: dict[int, list[int]] = {}
            for h in hits.tolist():
                for item in owners[left[h] : right[h]].tolist():
                    by_item.setdefault(item, []).append(h)
            by_size: dict[int, list[int]] = {}
            for item, places in by_item.items():
                by_size.setdefault(int(self.sizes[item]) - gram + 1, []).append(item)
            for size, items in by_size.items():
                if len(hashes) / size < least:  # at most so similar
                    continue
                size = min(size, len(hashes))  # a shorter document is the one window
                touched = np.unique(np.concatenate([by_item[i] for i in items]))
                self._windows(hashes, touched, size, set(items), least, best)
        for item, (similarity, start) in sorted(best.items()):
            yield self.ids[item], similarity, start, min(int(self.sizes[item]), len(words))

    def _windows(self, hashes, touched, size, items, least, best) -> None:
        """Compare the windows of ``size`` shingles that hold one of the places ``touched``."""
        low = np.maximum(touched - size + 1, 0)
        high = np.minimum(touched, len(hashes) - size)  # the last window's first shingle
        new = np.flatnonzero(np.append(True, low[1:] > np.maximum.accumulate(high)[:-1] + 1))
        ends = np.append(new[1:], len(low)) - 1
        for a, b in zip(low[new].tolist(), np.maximum.accumulate(high)[ends].tolist()):
            region = hashes[a : b + size]
            places, found = self.near(window_fingerprints(region, size))
            for place, item in zip(places.tolist(), found.tolist()):
                if item not in items:
                    continue
                window = Counter(region[place : place + size].tolist())
                similarity = weighted_jaccard(window, self.weights[item])
                if similarity >= least and (item not in best or (-similarity, a + place) < (-best[item][0], best[item][1])):
                    best[item] = (similarity, a + place)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    words_per_block: int = 1_000_000,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Rows of ``docs`` that hold a benchmark item: columns ``keep``, ``item_id``, the
    ``similarity`` of the best window, its ``start_word`` and ``n_words``.

    Words are separated by ASCII white space and A-Z lower-cased; shingles have five words and
    weigh as often as they occur. An item of fewer words is one shingle of all its words. A
    document of fewer words than an item is compared as a whole. A window must be within ``radius`` bits of the item and at least ``similarity`` alike. The
    items go to the tasks in blocks of about ``words_per_block`` words, one pass over the documents
    for each block, so what a task holds is bounded whatever the number of items. Null and empty texts or
    items match nothing; items with a null or repeated id each count; repeated documents each
    give their rows. Without documents or items the result is empty.
    """
    spark = docs.sparkSession
    workers_find_package(spark)
    read = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema if f.name != "text")
    schema = f"{schema}, {_SCHEMA}"
    found = None
    for block in _blocks(benchmark, words_per_block):
        part = read.mapInArrow(_search(spark.sparkContext.broadcast(block), keep, similarity, radius), schema)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    words_per_block: int = 1_000_000,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no benchmark item (see
    ``contaminated``). No row is shuffled."""
    spark = docs.sparkSession
    workers_find_package(spark)
    for block in _blocks(benchmark, words_per_block):
        docs = docs.mapInArrow(_clean(spark.sparkContext.broadcast(block), similarity, radius), docs.schema)
    return docs


def _clean(shared, similarity, radius):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items([(i, np.frombuffer(w, np.uint64)) for i, w in shared.value], radius)
        for batch in batches:
            clean = [next(items.matches(words_of(t.as_py()), similarity), None) is None for t in batch["text"]]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def _blocks(benchmark: DataFrame, most_words: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items as (id, word hashes), some at a time: a stated query set, in blocks."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    block, n_words = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        words = words_of(row["text"])
        if len(words):
            block.append((row["item_id"], words.tobytes()))
            n_words += len(words)
        if n_words >= most_words:
            yield block
            block, n_words = [], 0
    if block:
        yield block


def _search(shared, keep, similarity, radius):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items([(i, np.frombuffer(w, np.uint64)) for i, w in shared.value], radius)
        for batch in batches:
            rows, found = [], []
            for k, text in enumerate(batch["text"]):
                for match in items.matches(words_of(text.as_py()), similarity):
                    rows.append(k)
                    found.append(match)
            if rows:
                own = batch.take(pa.array(rows))
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(own[name] for name in keep),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.float64()),
                        pa.array(columns[2], pa.int64()),
                        pa.array(columns[3], pa.int64()),
                    ],
                    names=[*keep, "item_id", "similarity", "start_word", "n_words"],
                )

    return run
