"""The wide production-and-waste table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.measures import sum_of_parts, sum_parts
from larder.operators.clean import first_by_text
from larder.schemas import GRAIN, LOAD_DATE, LOCATION_ATTRIBUTES, SILVER


def waste_to_grain(waste: DataFrame, by_load: bool = False, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Waste events summed to one row per production key.

    Reason and stage are those of the largest event. Events are summed by key, reason and stage
    first, with numbers only in the buffers, so that raw rows are hashed and not sorted; a key
    with very many events shuffles a row per task and cause. The cause of a key is then picked
    from these few rows. With ``by_load`` they are also summed by load date, and the sums of a
    key's last load count; that load date is kept. ``dealt_by`` names columns that depend on the key
    alone: rows of a key are dealt by them instead of the key, and they are kept.
    """
    load, key = [LOAD_DATE] if by_load else [], [*dealt_by, *GRAIN]
    exact, plain, unfit = sum_parts("quantity_wasted")
    causes = waste.groupBy(*key, *load, "waste_reason", "waste_stage").agg(
        exact.alias("_exact"), plain.alias("_plain"), unfit.alias("_unfit"),
        F.max("quantity_wasted").alias("_largest"),
    )
    if dealt_by:
        causes = causes.repartition(*dealt_by)
    if by_load:
        last = F.max(LOAD_DATE).over(Window.partitionBy(*key))
        causes = causes.withColumn("_last", last).where(F.col("_last") == F.col(LOAD_DATE)).drop("_last")
    elif not dealt_by:
        # Few rows of a key are left, so they are dealt as they are, and sorted once, not on both sides.
        causes = causes.repartition(*GRAIN)
    return (
        causes.groupBy(*key, *load)
        .agg(
            sum_of_parts("_exact", "_plain", "_unfit").alias("quantity_wasted"),
            F.max(F.struct("_largest", "waste_reason", "waste_stage")).alias("_top"),
        )
        .select(*key, "quantity_wasted", "_top.waste_reason", "_top.waste_stage", *load)
    )


#: The columns of Silver that come from each of the sides joined to production.
OF_WASTE = (
    "quantity_wasted", "waste_reason", "waste_stage", "waste_percentage", "waste_cost", "quantity_consumed",
)
OF_MENU = ("sub_category", "veg_flag", "shelf_life_hours", "prep_complexity")
OF_LOCATION = tuple(c for c in LOCATION_ATTRIBUTES if c != "location_name")


#: The month of a key and the bucket it has there.
DEALT_BY = ("_y", "_m", "_bucket")


def with_buckets(feed: DataFrame, buckets: int) -> DataFrame:
    """``DEALT_BY`` for a cleaned feed. Rows dealt by these meet their key, and a task holds few months:
    it writes few files without another shuffle by month."""
    return feed.withColumns(
        {"_y": F.year("date"), "_m": F.month("date"), "_bucket": F.pmod(F.hash(*GRAIN), F.lit(buckets))}
    )


def menu_lookup(menu: DataFrame) -> DataFrame:
    """One row per menu item, without the columns production already carries."""
    return first_by_text(menu.select("menu_item_id", *OF_MENU), "menu_item_id")


def location_lookup(locations: DataFrame) -> DataFrame:
    """Cleaned locations without the name, which production already carries."""
    return locations.select("location_id", *OF_LOCATION)


def latest_loads(feed: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """The rows of each key from the last load date that has any for it. ``dealt_by`` as in
    ``waste_to_grain``."""
    if dealt_by:
        feed = feed.repartition(*dealt_by)
    last = Window.partitionBy(*dealt_by, *GRAIN).orderBy(F.desc(LOAD_DATE))
    return feed.withColumn("_rank", F.rank().over(last)).where("_rank = 1").drop("_rank")


def _with_waste(production: DataFrame, waste_grain: DataFrame) -> DataFrame:
    if LOAD_DATE not in waste_grain.columns:
        return production.join(waste_grain, list(GRAIN), "left")
    key = [*(c for c in DEALT_BY if c in waste_grain.columns), *GRAIN]
    waste = waste_grain.withColumnsRenamed({c: f"_w_{c}" for c in (*key, LOAD_DATE)})
    # In the order of the key, by which both sides are sorted already.
    matched = production[key[0]] == waste[f"_w_{key[0]}"]
    for c in key[1:]:
        matched = matched & (production[c] == waste[f"_w_{c}"])
    matched = matched & (F.col(f"_w_{LOAD_DATE}") >= F.col(LOAD_DATE))
    return production.join(waste, matched, "left").drop(*(f"_w_{c}" for c in (*key, LOAD_DATE)))


def build_silver(
    production: DataFrame, waste_grain: DataFrame | None, menu: DataFrame | None, locations: DataFrame | None
) -> DataFrame:
    """Production rows with their waste, menu and location attributes and four measures.

    ``waste_grain``, ``menu`` and ``locations`` hold one row per key (see the functions
    above). When they are stored tables, as in the batch run, Spark knows their size: it
    broadcasts a small one, and shuffles both sides of a large one directly below the join,
    where adaptive execution can split a skewed key. With load dates on both sides, waste of a
    load before the one that gave the production row is left out. A side that is None is not
    joined and its columns are missing; the rows are the same.
    """
    joined = production if waste_grain is None else _with_waste(production, waste_grain)
    if menu is not None:
        joined = joined.join(menu, "menu_item_id", "left")
    if locations is not None:
        joined = joined.join(locations, "location_id", "left")
    wasted, prepared = F.col("quantity_wasted"), F.col("quantity_prepared")
    measures = {
        "demand_gap": F.col("planned_quantity") - F.col("actual_served_estimate"),
        # Rows that are dealt by month are sorted by it as well.
        "year": F.col("_y") if "_y" in joined.columns else F.year("date"),
        "month": F.col("_m") if "_m" in joined.columns else F.month("date"),
    }
    if waste_grain is not None:
        joined = joined.withColumn("quantity_wasted", F.coalesce(wasted, F.lit(0.0)))
        measures |= {
            "waste_percentage": F.when(prepared > 0, wasted / prepared * 100).otherwise(0.0),
            "waste_cost": wasted * F.col("cost_per_unit"),
            "quantity_consumed": prepared - wasted,
        }
    measured = joined.withColumns(measures)
    return measured.select([c for c in SILVER.names if c in measured.columns])


def orphan_waste(waste: DataFrame, production: DataFrame) -> DataFrame:
    """Waste events without a production row; the Silver join leaves them out."""
    return waste.join(production.select(*GRAIN), list(GRAIN), "left_anti")


def waste_exceeds_prepared(waste: DataFrame, production: DataFrame) -> DataFrame:
    """Waste events larger than the quantity prepared under their key."""
    prepared = production.select(*GRAIN, "quantity_prepared")
    return waste.join(prepared, list(GRAIN), "left").where(
        F.col("quantity_wasted") > F.col("quantity_prepared")
    )
