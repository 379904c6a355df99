"""All pairs within groups, in pieces of bounded size.

A group of any size is dealt into tiles by a hash of its members, and every pair of tiles is
one unit of work: no task holds more than two tiles at once, and no pair is written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import Stored

TILE = 2048


def tile_pairs(
    rows: DataFrame, keys: list[str], member: str, stored: Stored, tile: int = TILE, within: bool = False
) -> DataFrame:
    """``rows`` of groups of two and more, with the work units ``tile_a`` and ``tile_b`` they
    belong to and ``tile``, their own. A group of one tile is the unit (0, 0). Of more tiles
    the units are the pairs a < b, and also a = b if ``within``. The work of a group grows with
    the square of its size, its copies in the shuffle with the square over the tile's size.
    The sizes are a stored table: only so both sides of the join that brings them to the members
    are shuffled directly below it, and adaptive execution splits a group of any size.
    """
    counts = stored.write(rows.groupBy(*keys).agg(F.count("*").alias("n_members")).where("n_members > 1"))
    n_tiles = F.ceil(F.col("n_members") / F.lit(tile)).cast("int")
    dealt = (
        rows.join(counts, keys)
        .withColumn("n_tiles", n_tiles)
        .withColumn("tile", F.pmod(F.xxhash64(F.lit("tile"), member), F.col("n_tiles")).cast("int"))
    )
    others = F.sequence(F.lit(0), F.col("n_tiles") - 1)
    if not within:
        others = F.filter(others, lambda x: (x != F.col("tile")) | (F.col("n_tiles") == 1))
    return (
        dealt.withColumn("other", F.explode(others))
        .withColumn("tile_a", F.least("tile", "other"))
        .withColumn("tile_b", F.greatest("tile", "other"))
        .drop("n_members", "n_tiles", "other")
    )


def in_units(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of one work unit together, in a stable order."""
    unit = [*keys, "tile_a", "tile_b"]
    return rows.repartition(*unit).sortWithinPartitions(*unit, *order)


def units(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole work units with the bounds of each, from sorted Arrow batches."""
    unit = [*keys, "tile_a", "tile_b"]
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        table = pa.Table.from_batches(rest).combine_chunks()
        last = _starts(table, unit)[-1]
        if last:
            whole = table.slice(0, last)
            yield whole, np.append(_starts(whole, unit), last)
            rest = table.slice(last).combine_chunks().to_batches()
    if rest:
        table = pa.Table.from_batches(rest).combine_chunks()
        yield table, np.append(_starts(table, unit), table.num_rows)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def linked_parts(linked: np.ndarray) -> np.ndarray:
    """The first member of the part each member belongs to; ``linked`` is a symmetric matrix
    of truth values."""
    n = len(linked)
    words = -(-n // 64)
    padded = np.zeros((n, words * 64), bool)
    padded[:, :n] = linked
    rows = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
    return parts_of(rows, n)


def parts_of(rows: np.ndarray, n: int) -> np.ndarray:
    """The same for rows of bits, 64 members to a word, the lowest bit first."""
    part = np.full(n, -1)
    for first in range(n):
        if part[first] >= 0:
            continue
        part[first] = first
        front = np.array([first])
        while len(front):
            reached = np.bitwise_or.reduce(rows[front], axis=0)
            members = np.flatnonzero(np.unpackbits(reached.view(np.uint8), bitorder="little")[:n])
            front = members[part[members] < 0]
            part[front] = first
    return part
