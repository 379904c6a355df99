"""Near-duplicate documents by SimHash, compared bit plane by bit plane.

Fingerprints are stored vertically: plane p holds bit p of 64 fingerprints in one word. One
exclusive-or gives 64 bit differences at once, carry-save counters add them up, and a block of
comparisons is left as soon as every distance in it is above the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.graph import components
from larder.llm.shared import Stored, workers_find_package
from larder.llm.tiles import in_units, parts_of, tile_pairs, units
from larder.llm.words import mixed

BITS = 64
_SEED = 42
_QUERIES = 256  # rows of a comparison at a time
_ABANDON = 8  # planes between two looks at what is left


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split() if text else []


def shingles_of(words: list[bytes], size: int) -> Iterator[bytes]:
    """Runs of ``size`` words joined by spaces, repeats included; of fewer words, all of them."""
    if len(words) < size:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(words[k:] for k in range(size))))


def hashes_of(text: str | None, size: int) -> np.ndarray:
    words = words_of(text)
    n = max(len(words) - size + 1, min(len(words), 1))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles_of(words, size), repeat(_SEED)), np.uint64, n)


def fingerprint_of(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; 0 without any."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``fingerprint`` (a signed 64-bit number) of every row of ``docs``."""
    workers_find_package(docs.sparkSession)
    read = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint_of(hashes_of(t.as_py(), size)) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [*(batch[name] for name in keep), pa.array(found, pa.int64())], names=[*keep, "fingerprint"]
            )

    return read.mapInArrow(run, f"{schema}, fingerprint long")


# --- comparison ----------------------------------------------------------------------------


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes of fingerprints: row p holds bit p of 64 fingerprints to a word."""
    lanes = -(-len(values) // 64) * 64
    padded = np.zeros(lanes, "<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def within_radius(values: np.ndarray, radius: int) -> np.ndarray:
    """Rows of bits: bit j of row i is set if fingerprints i and j differ in ``radius`` bits at
    most. Bits beyond the last fingerprint are 0."""
    planes = planes_of(values)
    n, width = len(values), planes.shape[1]
    valid = np.packbits(np.arange(width * 64) < n, bitorder="little").view(np.uint64)
    out = np.zeros((n, width), np.uint64)
    for start in range(0, n, _QUERIES):
        queries = values[start : start + _QUERIES]
        rows, near, _ = _compare(_against(queries, planes), (len(queries), width), radius)
        out[start + rows] = near & valid
    return out


def distances_within(values: np.ndarray, radius: int) -> np.ndarray:
    """Numbers of differing bits of all pairs; 255 above the radius."""
    planes = planes_of(values)
    n, width = len(values), planes.shape[1]
    out = np.full((n, n), 255, np.uint8)
    for start in range(0, n, _QUERIES):
        queries = values[start : start + _QUERIES]
        rows, near, apart = _compare(_against(queries, planes), (len(queries), width), radius)
        out[start + rows] = np.where(_lanes(near), _counted(apart, radius), 255)[:, :n]
    return out


def _lanes(words: np.ndarray) -> np.ndarray:
    """The bits of words as truth values, the lowest first."""
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=-1, bitorder="little").view(bool)


def _counted(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """The distances that vertical counters hold."""
    start = (1 << len(counters)) - 1 - radius
    return (sum(_lanes(c).astype(np.int16) << k for k, c in enumerate(counters)) - start).astype(np.uint8) if counters else np.uint8(0)


def _against(queries: np.ndarray, planes: np.ndarray):
    """Differences of each query with all lanes, plane by plane."""
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)

    def differences(p: int, rows: np.ndarray) -> np.ndarray:
        mask = np.where(queries[rows] >> np.uint64(p) & np.uint64(1), ones, np.uint64(0))
        return planes[p][None, :] ^ mask[:, None]

    return differences


def _compare(differences, shape: tuple[int, int], radius: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Add up differing bits: rows not abandoned, their lanes within the radius, the counters.

    The counters start so high that the step beyond the radius carries out of the highest one;
    that carry marks a lane as lost. A row all of whose lanes are lost is followed no further.
    """
    n_counters = radius.bit_length()
    start = (1 << n_counters) - 1 - radius
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    rows = np.arange(shape[0])
    counters = [np.full(shape, ones if start >> k & 1 else np.uint64(0)) for k in range(n_counters)]
    lost = np.zeros(shape, np.uint64)
    for p in range(BITS):
        carry = differences(p, rows)
        for counter in counters:
            counter ^= carry
            carry &= ~counter  # a bit that was 1 and is 0 now is carried
        lost |= carry
        if p % _ABANDON == _ABANDON - 1:
            left = (lost != ones).any(axis=1)
            if not left.all():
                rows, lost, counters = rows[left], lost[left], [c[left] for c in counters]
    return rows, ~lost, counters


def _neighbours(values: np.ndarray, groups: np.ndarray, radius: int) -> np.ndarray:
    """Links (i, j, distance) within many small groups at once: lane i of shift s compares
    fingerprint i with the one s places on. ``groups`` are the bounds, the largest group first."""
    sizes = np.diff(groups)
    links = [np.zeros((0, 3), np.int64)]
    for shift in range(1, int(sizes[0]) if len(sizes) else 0):
        n_groups = int(np.searchsorted(-sizes, -shift, side="left"))  # groups of more than shift
        end = groups[n_groups]
        owner = np.repeat(np.arange(n_groups), sizes[:n_groups])
        lanes = np.flatnonzero(np.arange(end) + shift < groups[owner + 1])
        a, b = planes_of(values[lanes]), planes_of(values[lanes + shift])
        rows, near, apart = _compare(lambda p, rows: (a[p] ^ b[p])[rows, None], (a.shape[1], 1), radius)
        hits = np.flatnonzero(_lanes(near).ravel())
        place = rows[hits >> 6] * 64 + (hits & 63)
        hits, place = hits[place < len(lanes)], place[place < len(lanes)]
        apart = np.broadcast_to(_counted(apart, radius), (len(rows), 64)).ravel()[hits]
        links.append(np.stack([lanes[place], lanes[place] + shift, apart], axis=1))
    return np.concatenate(links)


def _spanning(pairs) -> list[tuple[int, int]]:
    """The pairs, in order, that join what those before them have not."""
    above: dict[int, int] = {}

    def top(i: int) -> int:
        while (j := above.get(i, i)) != i:
            above[i] = above.get(j, j)
            i = j
        return i

    chosen = []
    for i, j, *alike in pairs:
        a, b = top(i), top(j)
        if a != b and all(test() for test in alike):
            above[max(a, b)] = min(a, b)
            chosen.append((i, j))
    return chosen


# --- links ---------------------------------------------------------------------------------

_SMALL = 48  # groups up to this size are compared many at a time


def links_in_units(rows: DataFrame, keys: list[str], radius: int, node: str = "fingerprint") -> DataFrame:
    """Links ``a``, ``b`` (values of ``node``) that join the near fingerprints of each work unit
    (see ``tiles``) to the parts that all links within the radius make.

    A unit gives fewer links than it has rows, whatever the number of near pairs: those of a
    spanning forest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in units(batches, keys):
            values = table["fingerprint"].to_numpy().view(np.uint64)
            nodes = table[node].to_numpy()
            found = []
            sizes = np.diff(bounds)
            for g in np.flatnonzero(sizes > _SMALL):
                own = values[bounds[g] : bounds[g + 1]]
                part = parts_of(within_radius(own, radius), len(own))
                moved = np.flatnonzero(part != np.arange(len(own)))
                found.append(np.stack([moved, part[moved]], axis=1) + bounds[g])
            small = np.flatnonzero(sizes <= _SMALL)
            small = small[np.argsort(-sizes[small], kind="stable")]
            if len(small):
                order = np.concatenate([np.arange(bounds[g], bounds[g + 1]) for g in small])
                links = _neighbours(values[order], np.append(0, np.cumsum(sizes[small])), radius)
                found.append(order[np.array(_spanning(links[:, :2].tolist()), np.int64).reshape(-1, 2)])
            links = np.concatenate(found)
            if len(links):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[links[:, k]]) for k in (0, 1)], names=["a", "b"])

    columns = list(dict.fromkeys(["fingerprint", node, *keys, "tile_a", "tile_b"]))
    return in_units(rows, keys, [node]).select(*columns).mapInArrow(run, "a long, b long")


def block_masks(radius: int, agree: int = 2) -> list[int]:
    """Masks of the bits two fingerprints within the radius can have in common.

    The bits are cut into radius + agree blocks. At most radius of them hold a difference, so at
    least ``agree`` blocks are equal: every near pair has the same bits under one of the masks.
    """
    n_blocks = radius + agree
    cuts = [BITS * k // n_blocks for k in range(n_blocks + 1)]
    blocks = [((1 << cuts[k + 1]) - 1) ^ ((1 << cuts[k]) - 1) for k in range(n_blocks)]
    return [sum(chosen) for chosen in combinations(blocks, agree)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_links(distinct: DataFrame, radius: int, stored: Stored) -> DataFrame:
    """Links ``a``, ``b`` among the distinct values of ``fingerprint`` that connect exactly the
    fingerprints reachable by steps of at most ``radius`` differing bits."""
    masks = [_signed(m) for m in block_masks(radius)]
    keyed = distinct.select("fingerprint", F.posexplode(F.array(*(F.lit(m) for m in masks))).alias("mask", "bits"))
    keyed = keyed.select("fingerprint", "mask", F.col("fingerprint").bitwiseAND(F.col("bits")).alias("block"))
    return links_in_units(tile_pairs(keyed, ["mask", "block"], "fingerprint", stored), ["mask", "block"], radius)


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) with its fingerprint and class.

    Returns ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest
    doc_id that can be reached over fingerprints at most ``radius`` bits apart. Null and empty
    texts have fingerprint zero and are linked like any other. A null doc_id keeps its row; it
    is never a class's id unless the class has no other. Repeated rows stay. Without rows the
    result is empty.
    """
    spark = docs.sparkSession
    workers_find_package(spark)
    stored = Stored(spark, "simhash")
    found = stored.write(fingerprints(docs, size))
    labels = classes(found, radius, stored)
    return found.join(labels, "fingerprint", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def classes(found: DataFrame, radius: int, stored: Stored) -> DataFrame:
    """``fingerprint`` and ``component_id`` of the distinct fingerprints of ``found``."""
    first = stored.write(found.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    parts = components(near_links(first.select("fingerprint"), radius, stored), stored)
    rooted = first.join(parts, F.col("fingerprint") == F.col("id"), "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("root")
    )
    smallest = stored.write(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    return stored.write(rooted.join(smallest, "root").select("fingerprint", "component_id"))


def without_near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each class of ``near_duplicates``: that of the smallest doc_id.

    Texts without words are one class. Null ids come last, so such a row stays only in a class
    without ids; of rows that are equal in id and text one stays. All columns of ``docs`` are kept,
    whatever their names.
    """
    spark = docs.sparkSession
    workers_find_package(spark)
    stored = Stored(spark, "near")
    found = stored.write(fingerprints(docs.select(*_own_key(), "text"), size, ("doc_id", "text_key")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    distinct = stored.write(found.groupBy("fingerprint").agg(first))
    parts = components(near_links(distinct.select("fingerprint"), radius, stored), stored)
    rooted = distinct.join(parts, F.col("fingerprint") == F.col("id"), "left")
    least = rooted.groupBy(F.coalesce("component", "fingerprint").alias("root")).agg(F.min("first").alias("first"))
    return _only(docs, stored.write(least.select("first.doc_id", "first.text_key")))


def _own_key() -> list[Column]:
    """``doc_id`` and ``text_key``, a digest of the text: what tells rows apart."""
    text_key = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    return [F.col("doc_id").cast("long").alias("doc_id"), text_key.alias("text_key")]


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` for each row of ``kept`` (``doc_id``, ``text_key``)."""
    rows = docs.select(F.struct("*").alias("row"), *_own_key())
    own = (rows["text_key"] == kept["text_key"]) & rows["doc_id"].eqNullSafe(kept["doc_id"])
    numbered = rows.join(kept, own, "left_semi").withColumn(
        "n", F.row_number().over(Window.partitionBy("text_key", "doc_id").orderBy(F.lit(1)))
    )
    return numbered.where("n = 1").select("row.*")


# --- similar texts -------------------------------------------------------------------------

ANCHORS = 6
_SETS = 256  # shingle sets to a tile


def _signatures(docs: DataFrame, size: int, anchors: int) -> DataFrame:
    """``doc_id``, ``text_key``, and of the distinct shingles of the text: ``set_id``, a hash of
    them all, ``fingerprint``, and ``anchors``, the smallest hashes in some scrambled orders."""
    seeds = mixed(np.arange(1, anchors + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, prints, least = [], [], []
            for text in batch["text"]:
                own = np.unique(hashes_of(text.as_py(), size))
                sets.append(int(mixed(own).sum(dtype=np.uint64).view(np.int64)))
                prints.append(fingerprint_of(own))
                least.append([mixed(own ^ s).min().view(np.int64) for s in seeds] if len(own) else [0] * anchors)
            if sets:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].cast(pa.int64()), batch["text_key"], pa.array(sets, pa.int64()),
                        pa.array(prints, pa.int64()), pa.array(least, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_key", "set_id", "fingerprint", "anchors"],
                )

    return docs.mapInArrow(
        run, "doc_id long, text_key binary, set_id long, fingerprint long, anchors array<long>"
    )


def _shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """``set_id`` and its distinct shingles ``own``, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(hashes_of(t.as_py(), size)).view(np.int64) for t in batch["text"]]
            if own:
                yield pa.RecordBatch.from_arrays(
                    [batch["set_id"], pa.array(own, pa.list_(pa.int64()))], names=["set_id", "own"]
                )

    return texts.mapInArrow(run, "set_id long, own array<long>")


def _alike(rows: DataFrame, similarity: float, radius: int) -> DataFrame:
    """Links ``a``, ``b`` that join the sets of each work unit to the parts that all pairs make
    which are within the radius and have the similarity. Pairs are tried from the nearest on; one
    whose sets are joined already is not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in units(batches, ["component"]):
            values = table["fingerprint"].to_numpy().view(np.uint64)
            nodes = table["set_id"].to_numpy()
            lists = table["own"].combine_chunks()
            found = []
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                own = [np.asarray(lists[k].values) for k in range(start, end)]

                def test(i: int, j: int) -> bool:
                    shared = len(np.intersect1d(own[i], own[j], assume_unique=True))
                    return shared >= similarity * (len(own[i]) + len(own[j]) - shared)

                apart = distances_within(values[start:end], radius)
                i, j = np.nonzero(np.triu(apart < 255, 1))
                order = np.argsort(apart[i, j], kind="stable")
                pairs = ((a, b, partial(test, a, b)) for a, b in zip(i[order].tolist(), j[order].tolist()))
                found += [(start + a, start + b) for a, b in _spanning(pairs)]
            if found:
                links = np.array(found)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[links[:, k]]) for k in (0, 1)], names=["a", "b"])

    columns = ["component", "tile_a", "tile_b", "set_id", "fingerprint", "own"]
    return in_units(rows, ["component"], ["set_id"]).select(*columns).mapInArrow(run, "a long, b long")


def without_similar(docs: DataFrame, size: int = 5, similarity: float = 0.8, radius: int = 18, anchors: int = ANCHORS) -> DataFrame:
    """``docs`` with one row of each class of similar texts: that of the smallest doc_id.

    Texts are alike if their distinct shingles of ``size`` words have that Jaccard similarity or
    more; classes are what such pairs connect. Of each text six hashes are taken that a pair at
    the similarity shares with that probability each; fingerprints that have two of them in
    common are compared bit plane by bit plane. In the groups that links within ``radius`` make,
    every pair within it is verified on the shingles, unless it is connected already. A pair of
    texts at the similarity 0.8 meets with probability 0.998 and is within 18 bits with 0.998. Texts without words are alike. Null ids
    come last, so such a row stays only in a class without ids; of rows that are equal in id and
    text one stays. All columns of ``docs`` are kept, whatever their names.
    """
    spark = docs.sparkSession
    workers_find_package(spark)
    stored = Stored(spark, "similar")
    keyed = docs.select(*_own_key(), "text")
    signed = stored.write(_signatures(keyed, size, anchors))
    sets = stored.write(
        signed.groupBy("set_id").agg(
            F.min("fingerprint").alias("fingerprint"), F.min("anchors").alias("anchors"), F.min("text_key").alias("text_key")
        )
    )
    pairs = [F.xxhash64(F.lit(k), *(F.col("anchors")[i] for i in chosen)) for k, chosen in enumerate(combinations(range(anchors), 2))]
    blocks = sets.select("set_id", "fingerprint", F.explode(F.array(*pairs)).alias("block"))
    links = links_in_units(tile_pairs(blocks, ["block"], "set_id", stored), ["block"], radius, node="set_id")
    met = stored.write(components(links, stored).withColumnRenamed("id", "set_id"))
    wanted = sets.join(met, "set_id").select("set_id", "text_key")
    texts = keyed.select("text_key", "text").join(wanted, "text_key").select("set_id", "text")
    known = stored.write(_shingle_sets(texts, size).dropDuplicates(["set_id"]).join(sets.select("set_id", "fingerprint"), "set_id"))
    dealt = tile_pairs(met, ["component"], "set_id", stored, tile=_SETS).join(known, "set_id")
    alike = stored.write(_alike(dealt, similarity, radius))
    stored.drop(known)
    parts = components(alike, stored).withColumnRenamed("id", "set_id")
    rooted = signed.select("doc_id", "text_key", "set_id").join(parts, "set_id", "left")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    kept = stored.write(
        rooted.groupBy(F.coalesce("component", "set_id").alias("root")).agg(first).select("first.doc_id", "first.text_key")
    )
    return _only(docs, kept)
