"""Reading and publishing stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.operators import quality
from larder.sources import versions

Gate = Callable[[DataFrame], None]

#: Lookups of up to so many rows, some 150 MB, are sent to every executor.
MOST_SENT = 1_000_000


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet files of a folder."""
    return spark.read.schema(schema).parquet(path)


def read_published(
    spark: SparkSession, path: str, schema: StructType, parts: Iterable[str] | None = None
) -> DataFrame:
    """A table of ``publish``, or the named partitions of it."""
    found = versions.read(spark, path, schema, parts)
    if found is None:
        raise FileNotFoundError(f"no table at {path}")
    return found


def read_if_present(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table, or None if it was never written or is deleted. Any other error is raised."""
    return versions.read(spark, path, schema)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    found = read_if_present(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def sent_if_small(lookup: DataFrame) -> DataFrame:
    """A stored lookup of few columns, to be broadcast if it has at most ``MOST_SENT`` rows, so that
    what is joined with it is not shuffled. Above that Spark decides. The rows are counted from the
    footers of the files."""
    return F.broadcast(lookup) if lookup.count() <= MOST_SENT else lookup


def sent_or_merged(lookup: DataFrame) -> DataFrame:
    """As ``sent_if_small``, but a larger lookup is never broadcast. Spark goes by the size of the packed
    files: 13 MB of them can be 600 MB in every executor."""
    return lookup.hint("broadcast" if lookup.count() <= MOST_SENT else "merge")


def _check_columns(df: DataFrame, partition_by: Sequence[str], name: str) -> None:
    missing = [c for c in partition_by if c not in df.columns]
    if missing:
        raise ValueError(f"[{name}] missing partition columns: {', '.join(missing)}")


def write_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], rebalance: bool = False
) -> None:
    """Replace exactly the partitions present in ``df``.

    With ``rebalance``, rows are shuffled by partition column first, in adaptive pieces: a
    large partition is split over tasks, small ones share a task, so files come out evenly
    sized. Without it the layout of ``df`` is kept and nothing is shuffled.
    """
    _check_columns(df, partition_by, path)
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .option("compression", "zstd")
        .parquet(path)
    )


def _digest(df: DataFrame) -> tuple:
    """Equal for equal rows in any order."""
    row = F.xxhash64(*df.columns)
    return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(row), F.sum(row.cast("decimal(38,0)"))).first())


def publish(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    gate: Gate | None = None,
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    whole: bool = False,
    counts: Mapping[str, Column] | None = None,
    name: str = "",
    without: Iterable[str] = (),
    note: Mapping | Callable[[Mapping], Mapping] | None = None,
    measures: Mapping[str, Column] | None = None,
    leave_out: Sequence[str] = (),
    unless_same: bool = False,
) -> bool:
    """Write a new version, check it, then commit it; True if the table changed.

    ``counts`` are aggregates that count rows that break a rule: they are taken while the rows are
    written, and the first above zero, in order, stops the run under ``name``. The columns in
    ``leave_out`` are there for them and not written. ``gate`` reads what was written and may
    raise as well. After a failure the table is as it was. Of a partitioned table
    the partitions in ``df`` are replaced, those in ``without`` go and the others stay; with
    ``whole``, or without partitions, the table is replaced altogether. ``note`` goes into the
    pointer; if it is a function, it is made from the values of ``measures``, aggregates that are
    taken in the same pass. With ``unless_same`` a table whose rows are equal stays as it is.
    ``df`` may read from ``path``.
    """
    _check_columns(df, partition_by, path)
    version, target = versions.new_folder(path)
    try:
        watched = {**(counts or {}), **(measures or {})}
        seen = quality.Watch(watched)
        if rebalance and partition_by:
            df = df.hint("rebalance", *partition_by)
        df = seen.on(df).drop(*leave_out)
        if partition_by:
            write_partitions(df, target, partition_by)
        else:
            df.write.option("compression", "zstd").parquet(target)
        found = seen.values()
        quality.raise_on_counts({c: found[c] for c in counts or {}}, name)
        written = read_table(spark, target, df.schema)
        before = versions.current(spark, path)
        if unless_same and before is not None:
            if _digest(versions.read(spark, path, df.schema)) == _digest(written):
                versions.discard(spark, path, version)
                return False
        if gate:
            gate(written)
        if callable(note):
            note = note(found)
        kept = {} if before is None or whole or not partition_by else dict(before.parts)
        for part in without:
            kept.pop(part, None)
        kept |= {p: version for p in versions.partitions_of(spark, path, version, len(partition_by))}
    except BaseException:
        versions.discard(spark, path, version)
        raise
    versions.commit(spark, path, versions.Pointer(kept, note or {}))
    return True
