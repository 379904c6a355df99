"""Dimension tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.text import surrogate_key
from larder.operators.clean import keep_first
from larder.schemas import (
    DIMS, LOCATION_ATTRIBUTES, MEAL_PERIODS, MENU_ATTRIBUTES, WASTE_REASONS,
)


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes for a column ``day`` of dates."""
    day = F.col("day")
    weekday = F.weekday(day) + 1
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("bigint").alias("date_sk"),
        F.date_format(day, "yyyy-MM-dd").alias("full_date"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (weekday >= 6).alias("is_weekend"),
    )


def _day_per_row(span: DataFrame, first: Column, last: Column) -> DataFrame:
    return span.select(F.explode(F.sequence(first, last)).alias("day"))


def dim_date(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    return calendar(_day_per_row(spark.range(1), F.lit(first), F.lit(last)))


def dim_date_covering(df: DataFrame, column: str = "date") -> DataFrame:
    """Whole years around the dates found in ``df``. Where ``df`` is stored by year, only the
    names of its partitions are read."""
    year = F.col("year") if "year" in df.columns else F.year(column)
    span = df.agg(F.min(year).alias("lo"), F.max(year).alias("hi")).where("lo is not null")
    first = F.make_date("lo", F.lit(1), F.lit(1))
    last = F.make_date("hi", F.lit(12), F.lit(31))
    return calendar(_day_per_row(span, first, last))


def dim_category(silver: DataFrame) -> DataFrame:
    names = silver.select(F.upper(F.trim("category")).alias("category_name"))
    return (
        names.where("category_name is not null")
        .distinct()
        .select(surrogate_key("category_name").alias("category_sk"), "category_name")
    )


def _fixed(spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
    rows = spark.createDataFrame([(v,) for v in values], f"{name}_name string")
    return rows.select(surrogate_key(f"{name}_name").alias(f"{name}_sk"), f"{name}_name")


def dim_meal_period(spark: SparkSession) -> DataFrame:
    return _fixed(spark, "meal_period", MEAL_PERIODS)


def dim_waste_reason(spark: SparkSession) -> DataFrame:
    return _fixed(spark, "waste_reason", WASTE_REASONS)


def latest_attributes(silver: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Attributes per key as of the key's latest date, ties settled by their text.

    Equal attribute sets are collapsed first by a hash aggregate with map-side combine;
    what is ranked is the few distinct sets, not the log rows.
    """
    sets = silver.groupBy(key, *attributes).agg(F.max("date").alias("_seen"))
    order = [F.col("_seen").desc_nulls_last(), *[F.col(a).asc_nulls_last() for a in attributes]]
    return keep_first(sets, [key], order).drop("_seen")


def overwrite_attributes(
    source: DataFrame, existing: DataFrame | None, key: str, sk: str
) -> DataFrame:
    """Type-1 upsert: attributes from ``source``, surrogate key kept if the key is known."""
    fresh = surrogate_key(key)
    if existing is None:
        return source.select(fresh.alias(sk), *source.columns)
    known = existing.select(key, F.col(sk).alias("_known"))
    return source.join(known, key, "left").select(
        F.coalesce("_known", fresh).alias(sk), *source.columns
    )


def dim_location(silver: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    source = latest_attributes(silver, "location_id", LOCATION_ATTRIBUTES)
    built = overwrite_attributes(source, existing, "location_id", "location_sk")
    return built.select(*DIMS["dim_location"].names)


def dim_menu(silver: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    source = latest_attributes(silver, "menu_item_id", MENU_ATTRIBUTES)
    built = overwrite_attributes(source, existing, "menu_item_id", "menu_sk")
    return built.select(*DIMS["dim_menu"].names)
