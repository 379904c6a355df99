"""Source registry, table schemas and fixed value lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {
        "s": T.StringType(),
        "d": T.DoubleType(),
        "i": T.IntegerType(),
        "l": T.LongType(),
        "b": T.BooleanType(),
        "D": T.DateType(),
    }
    fields = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields])


@dataclass(frozen=True)
class Source:
    """One raw feed: the file it arrives in, its columns and its key."""

    file: str
    key: tuple[str, ...]
    columns: tuple[str, ...]


GRAIN = ("date", "location_id", "menu_item_id", "meal_period")

# Feed names, file names, keys and columns of the raw feeds.
SOURCES = {
    "production_logs": Source(
        "macro_production_logs.csv",
        GRAIN,
        (
            "date", "location_id", "location_name", "meal_period", "menu_item_id",
            "menu_item_name", "category", "quantity_prepared", "unit", "cost_per_unit",
            "planned_quantity", "actual_served_estimate",
        ),
    ),
    "waste_logs": Source(
        "macro_waste_logs.csv",
        GRAIN,
        (
            "date", "location_id", "location_name", "meal_period", "menu_item_id",
            "menu_item_name", "category", "quantity_wasted", "unit", "waste_reason",
            "waste_stage",
        ),
    ),
    "menu_data": Source(
        "macro_menu_data.csv",
        ("menu_item_id",),
        (
            "menu_item_id", "menu_item_name", "category", "sub_category", "veg_flag",
            "standard_portion_size", "cost_per_unit", "shelf_life_hours", "prep_complexity",
        ),
    ),
    "location_data": Source(
        "macro_location_data.csv",
        ("location_id",),
        (
            "location_id", "location_name", "city", "region", "location_type", "capacity",
            "open_date", "manager_name", "storage_rating",
        ),
    ),
    "supplier_data": Source(
        "macro_supplier_data.csv",
        ("supplier_record_id",),
        (
            "supplier_record_id", "supplier_id", "menu_item_id", "supplier_name",
            "supplier_city", "supplier_cost", "lead_time_days", "quality_score",
            "effective_from", "effective_to", "is_current",
        ),
    ),
}

# How the columns of a feed are read; a column that is not named is text. "upper" and "lower"
# are texts of one case, "day" is an ISO date, "any day" one of any common form, "whole" and "number" are numbers.
READ_AS = {
    "production_logs": {
        "date": "day", "meal_period": "lower", "category": "upper", "quantity_prepared": "number",
        "cost_per_unit": "number", "planned_quantity": "number", "actual_served_estimate": "number",
    },
    "waste_logs": {
        "date": "day", "meal_period": "lower", "waste_reason": "lower", "quantity_wasted": "number",
    },
    "menu_data": {"category": "upper", "cost_per_unit": "number", "shelf_life_hours": "whole"},
    "location_data": {},
    "supplier_data": {
        "lead_time_days": "whole", "quality_score": "number", "effective_from": "any day",
    },
}

BRONZE_METADATA = ("ingestion_timestamp", "source_file", "batch_id")
LOAD_DATE = "load_date"

# The meal periods and waste reasons the star schema knows.
MEAL_PERIODS = ("breakfast", "lunch", "dinner", "snack")
WASTE_REASONS = (
    "overproduction", "spoilage", "low demand", "plate waste", "forecast miss", "prep error",
)

UNKNOWN_CATEGORY = "UNKNOWN"
OPEN_END = "9999-12-31"

LOCATION_ATTRIBUTES = (
    "location_name", "city", "region", "location_type", "capacity", "storage_rating",
)
MENU_ATTRIBUTES = (
    "menu_item_name", "category", "sub_category", "veg_flag", "shelf_life_hours",
    "prep_complexity",
)
SUPPLIER_COLUMNS = (
    "supplier_id", "supplier_name", "menu_item_id", "supplier_city", "lead_time_days",
    "quality_score",
)
SUPPLIER_TRACKED = ("supplier_name", "lead_time_days", "quality_score")

PARTITIONS = ("year", "month")

SILVER = _struct(
    "date:D location_id:s location_name:s meal_period:s menu_item_id:s menu_item_name:s "
    "category:s quantity_prepared:d unit:s cost_per_unit:d planned_quantity:d "
    "actual_served_estimate:d ingestion_timestamp:s source_file:s batch_id:s "
    "quantity_wasted:d waste_reason:s waste_stage:s sub_category:s veg_flag:s "
    "shelf_life_hours:i prep_complexity:s city:s region:s location_type:s capacity:s "
    "storage_rating:s waste_percentage:d waste_cost:d quantity_consumed:d demand_gap:d "
    "year:i month:i"
)

DIMS = {
    "dim_date": _struct(
        "date_sk:l full_date:s day_of_week:i day_name:s month:i month_name:s quarter:i "
        "year:i is_weekend:b"
    ),
    "dim_category": _struct("category_sk:s category_name:s"),
    "dim_meal_period": _struct("meal_period_sk:s meal_period_name:s"),
    "dim_waste_reason": _struct("waste_reason_sk:s waste_reason_name:s"),
    "dim_location": _struct(
        "location_sk:s location_id:s location_name:s city:s region:s location_type:s "
        "capacity:s storage_rating:s"
    ),
    "dim_menu": _struct(
        "menu_sk:s menu_item_id:s menu_item_name:s category:s sub_category:s veg_flag:s "
        "shelf_life_hours:i prep_complexity:s"
    ),
    "dim_supplier": _struct(
        "supplier_sk:s supplier_id:s supplier_name:s menu_item_id:s supplier_city:s "
        "lead_time_days:i quality_score:d effective_date:s expiry_date:s is_current:b"
    ),
}

FACTS = {
    "fact_production": _struct(
        "production_sk:s date_sk:l location_sk:s menu_sk:s meal_period_sk:s "
        "quantity_prepared:d cost_per_unit:d batch_id:s year:i month:i"
    ),
    "fact_waste": _struct(
        "waste_sk:s date_sk:l location_sk:s menu_sk:s meal_period_sk:s waste_reason_sk:s "
        "supplier_sk:s quantity_wasted:d waste_percentage:d waste_cost:d year:i month:i"
    ),
    "fact_consumption": _struct(
        "consumption_sk:s date_sk:l location_sk:s menu_sk:s quantity_prepared:d "
        "quantity_wasted:d quantity_consumed:d demand_gap:d year:i month:i"
    ),
    "fact_waste_summary": _struct(
        "location_sk:s category_sk:s category:s total_waste_quantity:d total_waste_cost:d "
        "avg_waste_percentage:d waste_event_count:l year:i month:i"
    ),
}

GOLD = {**DIMS, **FACTS}
