"""The driver's tables as the five raw feeds, by the mapping of FIXTURES.md.

Feeds are text with padding, as files would deliver them, so that the cleaning stages have
work to do.
"""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.schemas import SOURCES
from larder.sources.tables import sent_if_small, sent_or_merged

FIRST_LOAD = date(1995, 1, 1)
SECOND_LOAD = date(1998, 1, 1)

#: Order lines that one task sums to production.
LINES_OF_TASK = 250_000

# Fixed values of the mapping.
CATEGORY_OF_TYPE = {
    "ECONOMY": "Salads", "SMALL": "Dairy", "MEDIUM": "Main Course", "PROMO": "Starter",
    "STANDARD": "Beverage", "LARGE": "Breads",
}
MEAL_OF_PRIORITY = {"1": "Breakfast", "2": "Lunch", "3": "Dinner", "4": "Snack", "5": "Snack"}
LOCATION_TYPES = ["Campus", "Corporate", "Hospital", "Hostel"]
RATINGS = ["A", "B", "C"]
COMPLEXITY = ["Low", "Medium", "High"]
REASON_BY_SUPPLIER = [
    "Overproduction", "Spoilage", "Low Demand", "Plate Waste", "Forecast Miss", "Prep Error",
]
STAGE_BY_LINE = ["Serving", "Storage", "Preparation", "Portioning"]
FLAG_TEXTS = ["1", "True", "true", "1.0"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code(prefix: str, number: Column, width: int) -> Column:
    """Zero-padded code; a number with more digits keeps them all."""
    text = number.cast("string")
    padded = F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))
    return F.concat(F.lit(prefix), padded)


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _mapped(mapping: dict[str, str], column: Column) -> Column:
    entries = [F.lit(text) for pair in mapping.items() for text in pair]
    return F.try_element_at(F.create_map(*entries), column)


def location_id(k: Column) -> Column:
    return _code("LOC", k, 3)


def menu_item_id(k: Column) -> Column:
    return _code("MI", k, 7)


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the part of the log key they carry: day, nation and meal."""
    priority = F.substring("o_orderpriority", 1, 1)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("c_custkey"),
        "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("date"),
        _mapped(MEAL_OF_PRIORITY, priority).alias("meal_period"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customers, "c_custkey").drop("c_custkey")


def write_csv_feed(
    df: DataFrame, path: str, extra_field_where=None, files: int | None = None, packed: bool = False
) -> None:
    """A feed as a folder of CSV files; ``extra_field_where`` picks the records that get a field
    too many. ``files`` deals finished records over so many files, by their text: nothing is sorted
    for it, and the few tasks that write do nothing else. ``packed`` files are one task each to read."""
    columns = [c for c in df.columns if not c.startswith("_")]
    quoted = [
        F.when(F.col(c).isNotNull(), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
        for c in columns
    ]
    line = F.array_join(F.array(*quoted), ",", "")
    if extra_field_where is not None:
        line = F.when(extra_field_where, F.concat(line, F.lit(",one too many"))).otherwise(line)
    # One column whose name is the header and whose separator does not occur.
    plain = {"header": True, "sep": "\x01", "quote": "\x02", "escape": "\x02", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    records = df.select(line.alias("record"))
    if files:
        records = records.hint("repartition", files, "record")
    if packed:
        plain["compression"] = "gzip"
    records.select(F.col("record").alias(",".join(columns))).write.mode("overwrite").csv(path, **plain)


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sent_if_small(table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("menu_item_name"),
        _mapped(CATEGORY_OF_TYPE, F.col("p_type")).alias("category"),
        F.col("p_retailprice").cast("string").alias("cost_per_unit"),
    ))


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("location_name")
    )


def _as_feed(df: DataFrame, source: str) -> DataFrame:
    """The feed's columns as text, padded where the column is not a number or day."""
    plain = {
        "date", "quantity_prepared", "quantity_wasted", "cost_per_unit", "planned_quantity",
        "actual_served_estimate", "effective_from", "effective_to", "lead_time_days",
    }
    columns = []
    for name in SOURCES[source].columns:
        text = F.col(name).cast("string")
        if name not in plain:
            text = F.concat(F.lit("  "), text, F.lit(" \t"))
        columns.append(text.alias(name))
    extra = [c for c in df.columns if c.startswith("_")]
    return df.select(*columns, *extra)


def _cents(column: Column) -> Column:
    return F.sum(column.cast("decimal(18,4)")).cast("double")


def production_logs(
    spark: SparkSession, sf_dir: str, orders: DataFrame, status_other_than: str | None = None
) -> DataFrame:
    """``orders`` are the stored order keys; ``status_other_than`` leaves out the orders of
    one status (the orphan case). Hardly two lines share a key, so summing before the shuffle would
    hold all lines of a split: they are dealt by key first, over tasks in number as the lines."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_tax"
    )
    if status_other_than:
        orders = orders.where(F.col("o_orderstatus") != status_other_than)
    sales = lines.join(sent_or_merged(orders), "l_orderkey")
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(lines.count() / LINES_OF_TASK))
    key = ["date", "c_nationkey", "l_partkey", "meal_period"]
    quantity = F.col("l_quantity")
    logs = sales.repartition(tasks, *key).groupBy(*key).agg(
        _cents(quantity).alias("quantity_prepared"),
        _cents(quantity * (1 + F.col("l_tax"))).alias("planned_quantity"),
        _cents(quantity * (1 - F.col("l_discount"))).alias("actual_served_estimate"),
    )
    named = logs.join(_parts(spark, sf_dir), "l_partkey").join(_nations(spark, sf_dir), "c_nationkey")
    ready = named.withColumns(
        {
            "location_id": location_id(F.col("c_nationkey")),
            "menu_item_id": menu_item_id(F.col("l_partkey")),
            "unit": F.lit("portion"),
        }
    )
    return _as_feed(ready, "production_logs")


def waste_logs(
    spark: SparkSession, sf_dir: str, orders: DataFrame, times: float = 1.0
) -> DataFrame:
    """``times`` scales the wasted quantity (the waste-exceeds-prepared case)."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag").isin("R", "A") & (F.col("l_discount") > 0))
        .select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount"
        )
    )
    share = F.col("l_discount") * (1 + F.col("c_nationkey") % 10)
    wasted = F.col("l_quantity") * F.least(F.lit(1.0), share)
    events = lines.join(sent_or_merged(orders), "l_orderkey")
    named = events.join(_parts(spark, sf_dir), "l_partkey").join(_nations(spark, sf_dir), "c_nationkey")
    ready = named.withColumns(
        {
            "location_id": location_id(F.col("c_nationkey")),
            "menu_item_id": menu_item_id(F.col("l_partkey")),
            "unit": F.lit("portion"),
            "quantity_wasted": wasted * times if times != 1.0 else wasted,
            "waste_reason": _pick(REASON_BY_SUPPLIER, F.col("l_suppkey") % 6),
            "waste_stage": _pick(STAGE_BY_LINE, F.col("l_linenumber") % 4),
        }
    )
    return _as_feed(ready, "waste_logs")


def menu_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    ready = table(spark, sf_dir, "part").select(
        menu_item_id(F.col("p_partkey")).alias("menu_item_id"),
        F.col("p_name").alias("menu_item_name"),
        _mapped(CATEGORY_OF_TYPE, F.col("p_type")).alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.when(size % 2 == 0, "Yes").otherwise("No").alias("veg_flag"),
        F.lit("1").alias("standard_portion_size"),
        F.col("p_retailprice").alias("cost_per_unit"),
        size.alias("shelf_life_hours"),
        _pick(COMPLEXITY, size % 3).alias("prep_complexity"),
    )
    return _as_feed(ready, "menu_data")


def location_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    regions = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")
    )
    ready = (
        table(spark, sf_dir, "nation")
        .join(regions, "n_regionkey")
        .select(
            location_id(k).alias("location_id"),
            F.col("n_name").alias("location_name"),
            F.concat(F.lit("CITY_"), k % 10).alias("city"),
            "region",
            _pick(LOCATION_TYPES, k % 4).alias("location_type"),
            (200 + 40 * k).alias("capacity"),
            F.lit("1990-01-01").alias("open_date"),
            F.lit(None).alias("manager_name"),
            _pick(RATINGS, k % 3).alias("storage_rating"),
        )
    )
    return _as_feed(ready, "location_data")


def supplier_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier records of both loads, with the load day in ``_load``.

    First load: suppliers with k % 10 other than 7; for every sixth there is a later record
    that is not current. Second load: suppliers with k % 5 other than 4, quality raised by
    0.5 where k % 3 is 0.
    """
    k = F.col("s_suppkey")
    part = F.when(k % 10 == 9, k - 1).otherwise(k)
    base = table(spark, sf_dir, "supplier").select(
        k.alias("_k"),
        _code("SUP", k, 5).alias("supplier_id"),
        menu_item_id(part).alias("menu_item_id"),
        F.col("s_name").alias("supplier_name"),
        F.concat(F.lit("CITY_"), F.col("s_nationkey") % 10).alias("supplier_city"),
        F.col("s_acctbal").alias("supplier_cost"),
        (1 + k % 7).alias("lead_time_days"),
        (1 + ((k * 37) % 400) / 100).alias("quality_score"),
        _pick(FLAG_TEXTS, k % 4).alias("is_current"),
    )
    k = F.col("_k")

    def load(rows: DataFrame, tag: str, day: date, loaded: date) -> DataFrame:
        return rows.withColumns(
            {
                "supplier_record_id": F.concat(F.lit(tag), k.cast("string")),
                "effective_from": F.lit(day.isoformat()),
                "effective_to": F.lit(None),
                "_load": F.lit(loaded),
            }
        )

    first = base.where(k % 10 != 7)
    retired = first.where(k % 6 == 0).withColumns(
        {"is_current": F.lit("0"), "quality_score": F.lit(0.0)}
    )
    second = base.where(k % 5 != 4).withColumn(
        "quality_score",
        F.when(k % 3 == 0, F.col("quality_score") + 0.5).otherwise(F.col("quality_score")),
    )
    return (
        load(first, "A", FIRST_LOAD, FIRST_LOAD)
        .unionByName(load(retired, "B", date(1999, 1, 1), FIRST_LOAD))
        .unionByName(load(second, "C", SECOND_LOAD, SECOND_LOAD))
    )


def supplier_data(spark: SparkSession, sf_dir: str, loaded: date | None = None) -> DataFrame:
    records = supplier_records(spark, sf_dir)
    if loaded:
        records = records.where(F.col("_load") == F.lit(loaded))
    return _as_feed(records, "supplier_data").drop("_k", "_load")


LOGS = {"production_logs": production_logs, "waste_logs": waste_logs}
MASTERS = {
    "menu_data": menu_data, "location_data": location_data, "supplier_data": supplier_data,
}
