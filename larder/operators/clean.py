"""Typed versions of the landed feeds, by the contract of their columns. Unreadable values become
null; ``unreadable_report`` counts them, and the batch run stops at any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.text import strip, to_any_day, to_day, to_double, to_int
from larder.operators import quality
from larder.schemas import READ_AS, SOURCES


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``, which should be a total order.

    The rank filter runs before the shuffle as well (window group limit), so a key holding
    most rows sends one row per task, not all of them.
    """
    ranked = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def first_by_text(df: DataFrame, *key: str) -> DataFrame:
    """One row per key, ties settled by the remaining columns in order."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in key]
    return keep_first(df, key, rest or [F.col(key[0])])


def strip_text(df: DataFrame) -> DataFrame:
    """Strip every text column, leave the others."""
    return df.select(
        [strip(name).alias(name) if kind == "string" else F.col(name) for name, kind in df.dtypes]
    )


_READERS = {
    "text": F.trim,
    "upper": lambda c: F.upper(F.trim(c)),
    "lower": lambda c: F.lower(F.trim(c)),
    "day": to_day,
    "any day": to_any_day,
    "number": to_double,
    "whole": to_int,
}
_TYPED = ("day", "any day", "number", "whole")


def _kinds(df: DataFrame, source: str) -> dict[str, str]:
    """How each column of a feed is read, in the order of ``df``; others are left alone."""
    named = READ_AS[source]
    return {c: named.get(c, "text") for c in df.columns if c in SOURCES[source].columns}


def typed(df: DataFrame, source: str) -> DataFrame:
    """A landed feed with the types and cases its contract names."""
    kinds = _kinds(df, source)
    return df.select(*(_READERS[kinds[c]](c).alias(c) if c in kinds else F.col(c) for c in df.columns))


def unreadable_report(df: DataFrame, source: str) -> DataFrame:
    """check_name, failing_rows: for each typed column the rows of a landed feed that hold a text
    which is no date or finite number. All columns are counted in one pass."""
    checks = [
        (f"{c}_readable", _READERS[kind](c).isNotNull() | F.col(c).isNull())
        for c, kind in _kinds(df, source).items()
        if kind in _TYPED
    ]
    return quality.report(df, checks)


def clean_production(df: DataFrame) -> DataFrame:
    return typed(df, "production_logs")


def clean_waste(df: DataFrame) -> DataFrame:
    return typed(df, "waste_logs")


def clean_menu(df: DataFrame) -> DataFrame:
    return typed(df, "menu_data")


def clean_location(df: DataFrame) -> DataFrame:
    return first_by_text(typed(df, "location_data"), "location_id")


def clean_supplier(df: DataFrame) -> DataFrame:
    return typed(df, "supplier_data")
