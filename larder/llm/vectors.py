"""Near-duplicate vectors by a pivot-permutation index.

Reference vectors, the pivots, are drawn once. A vector is described by its nearest pivots in
order; near vectors have most of these in common. Lists hold the vectors that have the same three
pivots among their nearest, so two vectors meet in a list if and only if the count of pivots they
share is three or more; there they are verified by their cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.graph import components
from larder.llm.shared import Stored, workers_find_package
from larder.llm.tiles import in_units, linked_parts, tile_pairs, units

PIVOTS = 64  # one bit each in a word that says which are near
NEAREST = 6
SHARED = 3
COSINE = 0.9
_ROWS = 512  # rows of a comparison at a time


def _floats(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision; None for null ones and those with null components."""
    out = []
    for value in column:
        if not value.is_valid or value.values.null_count or not len(value.values):
            out.append(None)
        else:
            out.append(np.asarray(value.values, np.float64))
    return out


def unit_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``unit``, the vector over its length, of those that can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, units_ = [], []
            for vec_id, vector in zip(batch["vec_id"], _floats(batch[column])):
                if vector is None or not np.isfinite(vector).all():
                    continue
                largest = np.abs(vector).max()
                if largest > 0:
                    vector = vector / largest
                    ids.append(vec_id.as_py())
                    units_.append(vector / np.sqrt(vector @ vector))
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(units_, pa.list_(pa.float64()))], names=["vec_id", "unit"]
                )

    return vectors.select("vec_id", column).mapInArrow(run, "vec_id long, unit array<double>")


def pivots_of(vectors: DataFrame, n: int = PIVOTS, seed: int = 7) -> np.ndarray:
    """``n`` random directions of the vectors' dimension, the same for the same dimension."""
    row = vectors.select(F.size("unit").alias("n")).where("n > 0").groupBy("n").count().orderBy(F.desc("count"), "n").first()
    if row is None:
        return np.zeros((n, 0))
    drawn = np.random.default_rng(seed).standard_normal((n, row["n"]))
    return drawn / np.linalg.norm(drawn, axis=1, keepdims=True)


def nearest_pivots(points: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest pivots of each point, the nearest first; of equals the lower number."""
    return np.argsort(-(points @ pivots.T), axis=1, kind="stable")[:, :k]


def inverted_lists(unit: DataFrame, pivots: np.ndarray, nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """``list`` (a set of ``shared`` pivots, as bits), ``near`` (all the nearest ones, as bits),
    ``vec_id`` and ``unit``: a row for each list a vector is in. Vectors of another dimension
    than the pivots are compared among themselves, in the list 0 of their dimension."""
    spark = unit.sparkSession
    known = spark.sparkContext.broadcast(pivots)  # PIVOTS vectors
    chosen = list(combinations(range(nearest), shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = known.value
        for batch in batches:
            lengths = np.asarray(batch["unit"].value_lengths())
            usual = np.flatnonzero(lengths == pivots.shape[1])
            near = np.zeros(batch.num_rows, np.uint64)
            rows, lists = [], []
            if len(usual):
                points = np.stack([np.asarray(batch["unit"][i].values) for i in usual.tolist()])
                bits = np.uint64(1) << nearest_pivots(points, pivots, nearest).astype(np.uint64)
                near[usual] = np.bitwise_or.reduce(bits, axis=1)
                for places in chosen:
                    rows.append(usual)
                    lists.append(np.bitwise_or.reduce(bits[:, places], axis=1))
            odd = np.flatnonzero(lengths != pivots.shape[1])
            rows.append(odd)
            lists.append(np.zeros(len(odd), np.uint64))
            at = np.concatenate(rows)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(lists).view(np.int64)),
                        pa.array(lengths[at].astype(np.int32)),
                        pa.array(near[at].view(np.int64)),
                        batch["vec_id"].take(pa.array(at)),
                        batch["unit"].take(pa.array(at)),
                    ],
                    names=["list", "dim", "near", "vec_id", "unit"],
                )

    return unit.mapInArrow(run, "list long, dim int, near long, vec_id long, unit array<double>")


def _first_list(a: np.ndarray, b: np.ndarray, own: np.uint64) -> np.ndarray:
    """Whether ``own`` is the first list, by lowest pivots, that both ``a`` and ``b`` are in: a
    pair is counted there only."""
    common = a[:, None] & b[None, :]
    if own == 0:
        return np.ones(common.shape, bool)
    top = np.uint64(1) << np.uint64(int(own).bit_length() - 1)
    return (common & (top | (top - np.uint64(1)))) == own


def _verified(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    for table, bounds in units(batches, ["list", "dim"]):
        columns = {c: table[c].to_numpy() for c in ("list", "near", "vec_id", "tile", "tile_a", "tile_b", "dim")}
        flat = np.asarray(table["unit"].combine_chunks().values)
        ends = np.cumsum(columns["dim"].astype(np.int64))
        out = []
        for start, end in zip(bounds[:-1], bounds[1:]):
            dim = int(columns["dim"][start])
            points = flat[ends[start] - dim : ends[end - 1]].reshape(-1, dim)
            near = columns["near"][start:end].view(np.uint64)
            own = columns["list"][start : start + 1].view(np.uint64)[0]
            a, b = columns["tile_a"][start], columns["tile_b"][start]
            tile = columns["tile"][start:end]
            left, right = np.flatnonzero(tile == a), np.flatnonzero(tile == b)
            n = end - start
            counts = np.zeros(n, np.int64)
            part = np.arange(n)
            linked = None
            for k in range(0, len(left), _ROWS):
                rows = left[k : k + _ROWS]
                here = _first_list(near[rows], near[right], own)
                if not here.any():
                    continue
                here &= (points[rows] @ points[right].T) >= cosine
                if a == b:
                    here &= rows[:, None] != right[None, :]
                if not here.any():
                    continue
                if linked is None:
                    linked = np.zeros((n, n), bool)
                linked[np.ix_(rows, right)] |= here
                counts[rows] += here.sum(axis=1)
                if a != b:
                    counts[right] += here.sum(axis=0)
            if linked is not None:
                linked |= linked.T
                part = linked_parts(linked)
                met = np.flatnonzero(counts)
                ids = columns["vec_id"][start:end]
                out.append((ids[met], counts[met], ids[part[met]]))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*out)], names=["vec_id", "n_links", "other"]
            )


def vector_classes(vectors: DataFrame, cosine: float = COSINE, column: str = "embedding", pivots: np.ndarray | None = None) -> DataFrame:
    """Every row of ``vectors`` (``vec_id`` and the array ``column``) with its links and class.

    Returns ``vec_id``, ``n_links``, the number of other vectors found with that cosine or more,
    ``component_id``, the smallest vec_id reachable by links, and ``kept``, whether it is the
    row's own. Null, zero and empty vectors and those with null or non-finite components link
    with nothing. Vectors of different dimensions don't link. Equal vectors under different ids
    are different vectors; rows that repeat a vec_id, or have none, get a class of their own only
    by what their id reaches: they count as one vector, the first in order of its components.
    Without rows the result is empty. Pairs are never written out: a list gives a count and a
    link to the first of its part for each vector. A list of any size is compared in tiles.
    """
    spark = vectors.sparkSession
    workers_find_package(spark)
    stored = Stored(spark, "vectors")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), column)
    unit = unit_vectors(rows, column).where("vec_id is not null").groupBy("vec_id").agg(F.min("unit").alias("unit"))
    unit = stored.write(unit)
    lists = inverted_lists(unit, pivots_of(unit) if pivots is None else pivots)
    keys = ["list", "dim"]
    dealt = in_units(tile_pairs(lists, keys, "vec_id", stored, within=True), keys, ["tile", "vec_id"])
    found = stored.write(
        dealt.select("list", "dim", "near", "vec_id", "unit", "tile", "tile_a", "tile_b").mapInArrow(
            lambda batches: _verified(batches, cosine), "vec_id long, n_links long, other long"
        )
    )
    counts = found.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    parts = components(found.select(F.col("vec_id").alias("a"), F.col("other").alias("b")), stored)
    return (
        rows.select("vec_id")
        .join(counts, "vec_id", "left")
        .join(parts.withColumnRenamed("id", "vec_id"), "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"),
        )
    )
