"""Fact tables: Silver with the surrogate keys of the dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.measures import exact_mean, exact_sum
from larder.functions.text import surrogate_key
from larder.operators.clean import keep_first
from larder.schemas import FACTS, GRAIN, UNKNOWN_CATEGORY

Dims = dict[str, DataFrame]

#: The dimension of each surrogate key of a fact.
DIM_OF = {
    "date_sk": "dim_date", "location_sk": "dim_location", "menu_sk": "dim_menu", "meal_period_sk": "dim_meal_period",
    "waste_reason_sk": "dim_waste_reason", "supplier_sk": "dim_supplier", "category_sk": "dim_category",
}


def _with_date_key(df: DataFrame, dims: Dims) -> DataFrame:
    days = dims["dim_date"].select(F.col("full_date").cast("date").alias("date"), "date_sk")
    return df.join(days, "date", "left")


def _with_key(df: DataFrame, dim: DataFrame, key: str, sk: str, dim_key: str | None = None) -> DataFrame:
    """Left lookup of one surrogate key. Only key and surrogate key leave the dimension; no
    hint: Spark broadcasts it if its stored size is small, else joins by shuffle."""
    pairs = dim.select(F.col(dim_key or key).alias(key), sk)
    return df.join(pairs, key, "left")


#: What the facts over rows of Silver, all but the summary, read of it.
OF_SILVER = (
    *GRAIN, "quantity_prepared", "cost_per_unit", "batch_id", "quantity_wasted", "waste_reason", "waste_percentage",
    "waste_cost", "quantity_consumed", "demand_gap", "year", "month",
)


def with_menu_key(silver: DataFrame, dims: Dims) -> DataFrame:
    """What facts read of Silver, with the key of the item: where the items are too many to be broadcast,
    rows are shuffled for this once, and not for every fact."""
    return _with_key(silver.select(*OF_SILVER), dims["dim_menu"], "menu_item_id", "menu_sk")


def _with_keys(df: DataFrame, dims: Dims, columns: Sequence[str]) -> DataFrame:
    """The keys named in ``columns``. A dimension holds a key once, so a lookup left out changes no rows."""
    # The menu first: where it is too large to be broadcast, no other key is shuffled for it.
    if "menu_sk" in columns and "menu_sk" not in df.columns:
        df = _with_key(df, dims["dim_menu"], "menu_item_id", "menu_sk")
    if "date_sk" in columns:
        df = _with_date_key(df, dims)
    if "location_sk" in columns:
        df = _with_key(df, dims["dim_location"], "location_id", "location_sk")
    if "meal_period_sk" in columns:
        df = _with_key(
            df, dims["dim_meal_period"], "meal_period", "meal_period_sk", "meal_period_name"
        )
    return df


def fact_production(silver: DataFrame, dims: Dims) -> DataFrame:
    columns = FACTS["fact_production"].names
    keyed = _with_keys(silver, dims, columns).withColumn("production_sk", surrogate_key(*GRAIN))
    return keyed.select(*columns)


def current_suppliers(dim_supplier: DataFrame, pick: str = "all") -> DataFrame:
    """menu_item_id, supplier_sk of current versions.

    ``pick="all"`` keeps every supplier of an item, so a waste row of an item with two
    suppliers appears twice; ``pick="best_quality"`` keeps one supplier per item.
    """
    current = dim_supplier.where("is_current")
    if pick == "best_quality":
        order = [F.col("quality_score").desc_nulls_last(), F.col("supplier_sk")]
        current = keep_first(current, ["menu_item_id"], order)
    elif pick != "all":
        raise ValueError("pick must be 'all' or 'best_quality'")
    return current.select("menu_item_id", "supplier_sk")


def fact_waste(
    silver: DataFrame, dims: Dims, pick: str = "all",
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
    columns: Sequence[str] = tuple(FACTS["fact_waste"].names),
) -> DataFrame:
    """Rows that have a reason. The supplier key may be null: not every item has one.

    ``stage`` may store the picked suppliers, so that their size is known to the join. Keys that
    ``columns`` leaves out are not looked up; the suppliers are, as they change the rows.
    """
    keyed = _with_keys(silver.where("waste_reason is not null"), dims, columns)
    if "waste_reason_sk" in columns:
        keyed = _with_key(
            keyed, dims["dim_waste_reason"], "waste_reason", "waste_reason_sk", "waste_reason_name"
        )
    suppliers = current_suppliers(dims["dim_supplier"], pick)
    if pick != "all":
        suppliers = stage(suppliers)
    keyed = keyed.join(suppliers, "menu_item_id", "left")
    keyed = keyed.withColumn("waste_sk", surrogate_key(*GRAIN, "supplier_sk"))
    return keyed.select(*columns)


def fact_consumption(silver: DataFrame, dims: Dims) -> DataFrame:
    columns = FACTS["fact_consumption"].names
    keyed = _with_keys(silver, dims, columns).withColumn("consumption_sk", surrogate_key(*GRAIN))
    return keyed.select(*columns)


def summarise_waste(silver: DataFrame) -> DataFrame:
    """Totals, mean percentage and event count by location, category and month, over rows
    where something was wasted."""
    category = F.coalesce(F.upper(F.trim("category")), F.lit(UNKNOWN_CATEGORY))
    return (
        silver.where("quantity_wasted > 0")
        .groupBy("location_id", category.alias("category"), "year", "month")
        .agg(
            exact_sum("quantity_wasted").alias("total_waste_quantity"),
            exact_sum("waste_cost").alias("total_waste_cost"),
            exact_mean("waste_percentage").alias("avg_waste_percentage"),
            F.count("quantity_wasted").alias("waste_event_count"),
        )
    )


def fact_waste_summary(silver: DataFrame, dims: Dims) -> DataFrame:
    keyed = _with_key(
        summarise_waste(silver), dims["dim_location"], "location_id", "location_sk"
    )
    keyed = _with_key(keyed, dims["dim_category"], "category", "category_sk", "category_name")
    return keyed.select(*FACTS["fact_waste_summary"].names)
