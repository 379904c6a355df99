"""Landing of raw feeds: CSV to text-only Parquet, one folder per source and load date."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.text import na_to_null, to_day
from larder.operators import quality
from larder.operators.clean import strip_text
from larder.schemas import BRONZE_METADATA, LOAD_DATE, SOURCES
from larder.sources import files, versions
from larder.sources.tables import publish, read_published

MALFORMED = "_malformed"
SOURCE_FILE = "source_file"
_MONTHS = "months"


def _read_alike(
    spark: SparkSession, paths: Sequence[str], multiline: bool, malformed: str | None, file: str | None
) -> DataFrame:
    """Files of one header."""
    options = {
        "header": True, "quote": '"', "escape": '"', "multiLine": multiline, "enforceSchema": False,
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }
    names = spark.read.csv(paths[0], **options).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    if malformed:
        schema = schema.add(malformed, T.StringType())
        options |= {"columnNameOfCorruptRecord": malformed, "mode": "PERMISSIVE"}
    raw = spark.read.csv(list(paths), schema=schema, **options)
    kept = [na_to_null(F.col(f"`{c}`")).alias(c) for c in names]
    name = [F.col("_metadata.file_name").alias(file)] if file else []
    return raw.select(*kept, *([malformed] if malformed else []), *name)


def headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a feed by their first line."""
    found: dict[str, list[str]] = {}
    paths = files.data_files(spark, path)
    with ThreadPoolExecutor(16) as pool:
        for one, line in zip(paths, pool.map(lambda p: files.first_line(spark, p), paths)):
            found.setdefault(line or "", []).append(one)
    return found


def read_csv(
    spark: SparkSession, path: str, multiline: bool = False, malformed: str | None = None,
    required: Iterable[str] = (), file: str | None = None,
) -> DataFrame:
    """A CSV file, or a folder of them, with headers, every column as text, missing-value texts
    as null.

    Files whose headers differ, in names or in order, are read by their own header each and put
    together by name; a column that some files lack is null there. Columns in ``required`` must be
    in all. ``multiline`` allows line breaks inside quotes, at the price that one file is read by
    one task. ``malformed`` names a further column that holds the text of records with more or
    fewer fields than their header, and null for all others; ``file`` one for the file's name.
    """
    groups = list(headers(spark, path).values()) or [[path]]
    found = None
    for paths in groups:
        one = _read_alike(spark, paths, multiline, malformed, file)
        missing = [c for c in required if c not in one.columns]
        if missing:
            raise ValueError(f"missing columns: {', '.join(missing)} in {paths[0]}")
        found = one if found is None else found.unionByName(one, allowMissingColumns=True)
    return found


def read_feed(spark: SparkSession, folder: str, source: str, multiline: bool = False) -> DataFrame:
    """A feed with all columns of its contract, ``_malformed`` and ``source_file``. Further columns
    are kept."""
    feed = SOURCES[source]
    try:
        return read_csv(spark, f"{folder.rstrip('/')}/{feed.file}", multiline, MALFORMED, feed.columns, SOURCE_FILE)
    except ValueError as error:
        raise ValueError(f"[{source}] {error}") from None


def malformed_report(df: DataFrame) -> DataFrame:
    """check_name, failing_rows: records with more or fewer fields than the header."""
    # The other columns are read too, or Spark would not split the records.
    touched = F.length(F.concat_ws("", *(c for c in df.columns if c != MALFORMED))) >= 0
    return quality.report(df, [("well_formed", F.col(MALFORMED).isNull() & touched)])


def with_metadata(df: DataFrame, source: str, batch_id: str, ingested_at: str) -> DataFrame:
    """``source_file`` is that of the record, or the feed's file where the rows carry none."""
    file = F.col(SOURCE_FILE) if SOURCE_FILE in df.columns else F.lit(SOURCES[source].file)
    return df.withColumns(
        {"ingestion_timestamp": F.lit(ingested_at), SOURCE_FILE: file, "batch_id": F.lit(batch_id)}
    )


def _counts(df: DataFrame, source: str) -> dict[str, Column]:
    """Well-formed, rows present, key columns not null."""
    well_formed = {"well_formed": F.count_if(F.col(MALFORMED).isNotNull())} if MALFORMED in df.columns else {}
    return well_formed | quality.key_nulls(SOURCES[source].key)


def bronze_path(root: str, source: str) -> str:
    return f"{root}/source={source}"


def _part(load_date: date) -> str:
    return f"{LOAD_DATE}={load_date.isoformat()}"


def land(
    spark: SparkSession, raw: DataFrame, source: str, root: str, run_date: date,
    batch_id: str, ingested_at: str,
) -> None:
    """Strip, add metadata, check and store one feed; a rerun replaces its load date.

    The checks are counted while the rows are written. So are the months that a dated feed holds:
    they go into the table's pointer, where ``loads_of_months`` looks them up.
    """
    ready = with_metadata(strip_text(raw), source, batch_id, ingested_at)
    ready = ready.withColumn(LOAD_DATE, F.lit(run_date))
    path = bronze_path(root, source)
    before = versions.current(spark, path)
    held = dict(before.note) if before else {}
    months = {_MONTHS: F.collect_set(F.date_format(to_day("date"), "yyyy-MM"))} if "date" in SOURCES[source].key else {}
    publish(
        spark, ready, path, partition_by=[LOAD_DATE], counts=_counts(ready, source), name=source,
        measures=months, note=lambda found: held | {_part(run_date): sorted(found[m]) for m in months},
        leave_out=[c for c in (MALFORMED,) if c in ready.columns],
    )


def months_of_load(spark: SparkSession, root: str, source: str, load_date: date) -> list[str]:
    """The months ("2025-01") that one load of a dated feed holds."""
    found = versions.current(spark, bronze_path(root, source))
    return [] if found is None else list(found.note.get(_part(load_date), []))


def loads_of_months(spark: SparkSession, root: str, source: str, months: Iterable[str]) -> list[str]:
    """The load-date folders of a dated feed that hold any of these months."""
    found, wanted = versions.current(spark, bronze_path(root, source)), set(months)
    return [] if found is None else [p for p in found.parts if not wanted.isdisjoint(found.note.get(p, wanted))]


def bronze_schema(source: str) -> T.StructType:
    text = [*SOURCES[source].columns, *BRONZE_METADATA]
    fields = [T.StructField(c, T.StringType()) for c in text]
    return T.StructType([*fields, T.StructField(LOAD_DATE, T.DateType())])


def read_bronze(
    spark: SparkSession, root: str, source: str, load_date: date | None = None,
    months: Iterable[str] | None = None,
) -> DataFrame:
    """One source; of one load date, of the loads that hold any of the months, or all of it. Only
    the folders of these loads are listed and read."""
    parts = None if load_date is None else [_part(load_date)]
    if months is not None:
        parts = loads_of_months(spark, root, source, months)
    path = bronze_path(root, source)
    df = read_published(spark, path, bronze_schema(source), parts)
    return df if load_date is None else df.where(F.col(LOAD_DATE) == F.lit(load_date))
