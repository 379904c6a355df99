"""Small frames with the columns of the cleaned feeds."""

from datetime import date

PRODUCTION = (
    "date date, location_id string, menu_item_id string, meal_period string, "
    "quantity_prepared double, cost_per_unit double, planned_quantity double, "
    "actual_served_estimate double, batch_id string, menu_item_name string, category string, "
    "location_name string, unit string"
)
WASTE = (
    "date date, location_id string, menu_item_id string, meal_period string, "
    "quantity_wasted double, waste_reason string, waste_stage string"
)
MENU = (
    "menu_item_id string, menu_item_name string, category string, sub_category string, "
    "veg_flag string, cost_per_unit double, shelf_life_hours int, prep_complexity string"
)
LOCATION = (
    "location_id string, location_name string, city string, region string, "
    "location_type string, capacity string, storage_rating string"
)
DAY = date(2025, 1, 1)


def production(spark, *rows):
    """Rows of (prepared, cost, planned, served), or dicts of changes to a default row."""
    default = {
        "date": DAY, "location_id": "LOC001", "menu_item_id": "MI001", "meal_period": "lunch",
        "quantity_prepared": 100.0, "cost_per_unit": 50.0, "planned_quantity": 110.0,
        "actual_served_estimate": 90.0, "batch_id": "b1", "menu_item_name": "Dal Rice",
        "category": "MAIN COURSE", "location_name": "Campus Cafe", "unit": "portion",
    }
    return spark.createDataFrame([{**default, **r} for r in rows], PRODUCTION)


def waste(spark, *rows):
    default = {
        "date": DAY, "location_id": "LOC001", "menu_item_id": "MI001", "meal_period": "lunch",
        "quantity_wasted": 20.0, "waste_reason": "overproduction", "waste_stage": "Serving",
    }
    return spark.createDataFrame([{**default, **r} for r in rows], WASTE)


def menu(spark, *ids):
    rows = [(i, "Dal Rice", "MAIN COURSE", "sub", "Yes", 67.0, 24, "Low") for i in ids or ("MI001",)]
    return spark.createDataFrame(rows, MENU)


def locations(spark, *ids):
    rows = [
        (i, "Campus Cafe", "Bangalore", "South", "Campus", "500", "A") for i in ids or ("LOC001",)
    ]
    return spark.createDataFrame(rows, LOCATION)


def silver(spark, production_rows=({},), waste_rows=({},)):
    from larder.operators import silver as s

    return s.build_silver(
        production(spark, *production_rows),
        s.waste_to_grain(waste(spark, *waste_rows)),
        s.menu_lookup(menu(spark, "MI001", "MI002")),
        s.location_lookup(locations(spark, "LOC001", "LOC002")),
    )


def final_plan(df):
    """The physical plan after adaptive execution has run it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
