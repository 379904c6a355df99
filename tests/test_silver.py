from datetime import date

import pytest
from pyspark.sql import functions as F

from larder.operators import clean, quality, silver
from larder.plans import batch, workspace
from larder.schemas import GRAIN
from tests import builders


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_derived_columns(spark):
    row = one(builders.silver(spark))
    assert row.waste_percentage == pytest.approx(20.0)
    assert row.waste_cost == pytest.approx(1000.0)
    assert row.quantity_consumed == pytest.approx(80.0)
    assert row.demand_gap == pytest.approx(20.0)
    assert (row.year, row.month) == (2025, 1)
    assert (row.city, row.veg_flag) == ("Bangalore", "Yes")


def test_consumed(spark):
    row = one(builders.silver(spark, waste_rows=[{"quantity_wasted": 30.0}]))
    assert row.quantity_consumed == pytest.approx(70.0)


def test_gate_fails_when_waste_exceeds_prepared(spark):
    df = builders.silver(
        spark, [{"quantity_prepared": 50.0}], [{"quantity_wasted": 80.0}]
    )
    with pytest.raises(ValueError, match="DQ GATE FAILED: waste_lte_prepared"):
        quality.gate(df, quality.silver_checks())


def test_gate_passes_valid_row(spark):
    quality.gate(builders.silver(spark), quality.silver_checks())


def test_unknown_reason_fails_and_missing_reason_passes(spark):
    bad = builders.silver(spark, waste_rows=[{"waste_reason": "other"}])
    with pytest.raises(ValueError, match="valid_waste_reason"):
        quality.gate(bad, quality.silver_checks())
    none = builders.silver(spark, waste_rows=[{"menu_item_id": "MI999"}])
    assert one(none).waste_reason is None
    assert one(none).quantity_wasted == 0.0
    quality.gate(none, quality.silver_checks())


def test_nothing_prepared_gives_zero_percent(spark):
    row = one(builders.silver(spark, [{"quantity_prepared": 0.0}]))
    assert row.waste_percentage == 0.0


def test_many_events_collapse_to_the_largest_reason(spark):
    events = [
        {"quantity_wasted": 5.0, "waste_reason": "spoilage", "waste_stage": "Storage"},
        {"quantity_wasted": 7.5, "waste_reason": "prep error", "waste_stage": "Preparation"},
        {"quantity_wasted": 7.5, "waste_reason": "low demand", "waste_stage": "Serving"},
    ]
    for rows in (events, events[::-1]):
        row = one(silver.waste_to_grain(builders.waste(spark, *rows)))
        assert (row.quantity_wasted, row.waste_reason) == (20.0, "prep error")
        assert row.waste_stage == "Preparation"


def test_orphan_waste_vanishes_from_silver_but_is_reported(spark):
    rows = builders.waste(spark, {}, {"menu_item_id": "MI999"})
    produced = builders.production(spark, {})
    assert one(silver.orphan_waste(rows, produced)).menu_item_id == "MI999"
    assert builders.silver(spark, waste_rows=[{}, {"menu_item_id": "MI999"}]).count() == 1


def test_waste_exceeding(spark):
    rows = builders.waste(spark, {"quantity_wasted": 101.0}, {"quantity_wasted": 100.0})
    assert one(silver.waste_exceeds_prepared(rows, builders.production(spark, {}))).quantity_wasted == 101.0


def test_null_keys_do_not_match(spark):
    df = builders.silver(spark, [{"meal_period": None}], [{"meal_period": None}])
    assert one(df).quantity_wasted == 0.0


def test_category_is_upper_case_everywhere(spark):
    raw = builders.production(spark, {"category": " Main Course "}).withColumn(
        "date", F.col("date").cast("string")
    )
    assert one(clean.clean_production(raw)).category == "MAIN COURSE"


def test_bad_text_becomes_null(spark):
    raw = spark.createDataFrame(
        [("2025-13-45", "x1", "\tMI1 ", "L1", " LUNCH ", "Spoilage ", "s")],
        "date string, quantity_wasted string, menu_item_id string, location_id string, "
        "meal_period string, waste_reason string, waste_stage string",
    )
    row = one(clean.clean_waste(clean.strip_text(raw)))
    assert (row.date, row.quantity_wasted) == (None, None)
    assert (row.menu_item_id, row.meal_period, row.waste_reason) == ("MI1", "lunch", "spoilage")


def test_whole_numbers_with_a_point_are_read(spark):
    raw = spark.createDataFrame(
        [("m", "n", "c", "s", "2.5", "24.0")],
        "menu_item_id string, menu_item_name string, category string, sub_category string, "
        "cost_per_unit string, shelf_life_hours string",
    )
    assert one(clean.clean_menu(raw)).shelf_life_hours == 24


def test_location_dedupe_is_stable(spark):
    rows = [("L1", "B", "x", "r"), (" L1", "A", "y", "r"), ("L2", "C", "z", "r")]
    schema = "location_id string, location_name string, city string, region string"
    for order in (rows, rows[::-1]):
        df = clean.clean_location(spark.createDataFrame(order, schema))
        assert {(r.location_id, r.location_name) for r in df.collect()} == {("L1", "A"), ("L2", "C")}


def test_strip_knows_all_whitespace(spark):
    df = spark.createDataFrame([("\t\n a b\x0b\xa0　",)], "t string")
    assert one(clean.strip_text(df)).t == "a b"


def test_keep_first_ranks_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id % 3 as k", "id as v").write.parquet(path)
    df = clean.keep_first(spark.read.parquet(path), ["k"], [F.desc("v")])
    assert {(r.k, r.v) for r in df.collect()} == {(0, 999), (1, 997), (2, 998)}
    plan = builders.final_plan(df)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")
    assert "Partial" in plan


def test_hot_key_is_split_by_the_silver_join(spark, tmp_path, conf):
    """A third of production on one key: the join splits that partition over tasks."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    spark.sparkContext.setLogLevel("ERROR")
    many = (
        spark.range(0, 30000, 1, 6)
        .selectExpr(
            "date'2025-01-01' as date", "'LOC001' as location_id",
            "if(id % 3 = 0, 'MI001', concat('MI', id)) as menu_item_id",
            "'lunch' as meal_period", "100D as quantity_prepared", "50D as cost_per_unit",
            "110D as planned_quantity", "90D as actual_served_estimate",
            "cast(uuid() as string) as batch_id",
        )
    )
    for name, df in {
        "p": many, "w": silver.waste_to_grain(builders.waste(spark, {}, {})),
        "m": silver.menu_lookup(builders.menu(spark)),
        "l": silver.location_lookup(builders.locations(spark)),
    }.items():
        df.write.parquet(str(tmp_path / name))
    p, w, m, l = (spark.read.parquet(str(tmp_path / n)) for n in "pwml")
    built = silver.build_silver(p, w, m, l)
    plan = builders.final_plan(built)
    assert "skew=true" in plan
    assert built.agg(F.count("*"), F.sum("quantity_wasted")).first() == (30000, 400000.0)


def test_dates_survive(spark):
    assert one(builders.silver(spark)).date == date(2025, 1, 1)


def test_hot_key_of_one_load_is_summed_over_tasks(spark, tmp_path):
    """Very many events of one key in its last load: no task but the scans sees more than the few
    sums of each, and the last load of a key still decides."""
    schema = f"{builders.WASTE}, load_date date"
    events = spark.range(0, 60000, 1, 6).selectExpr(
        "date'2025-01-01' as date", "'LOC001' as location_id", "if(id % 2 = 0, 'MI001', concat('MI', id % 50)) as menu_item_id",
        "'lunch' as meal_period", "1D as quantity_wasted", "if(id % 3 = 0, 'spoilage', 'overproduction') as waste_reason", "'Serving' as waste_stage",
        "if(id % 2 = 0, date'2025-02-02', date'2025-02-01') as load_date",
    )
    events.write.parquet(str(tmp_path / "w"))
    stored = spark.read.schema(schema).parquet(str(tmp_path / "w"))
    plan = silver.waste_to_grain(stored, by_load=True)._jdf.queryExecution().executedPlan().toString()
    # The window runs over sums: below it stands an aggregate, not the scan.
    below = plan[plan.index("Window") :]
    assert "HashAggregate" in below and below.index("HashAggregate") < below.index("Scan parquet")
    rows = {r.menu_item_id: r for r in silver.waste_to_grain(stored, by_load=True).collect()}
    assert rows["MI001"].quantity_wasted == 30000.0 and str(rows["MI001"].load_date) == "2025-02-02"
    assert rows["MI001"].waste_reason == "spoilage" and len(rows) == 26


def test_only_the_last_load_of_a_key_counts(spark):
    schema = f"{builders.WASTE}, load_date date"
    key = (builders.DAY, "LOC001", "MI001", "lunch")
    rows = [(*key, 5.0, "spoilage", "Serving", date(2025, 2, 1)), (*key, 1.0, "overproduction", "Storage", date(2025, 2, 2)),
            (*key, 2.0, "plate waste", "Serving", date(2025, 2, 2)), (None, None, "MI001", None, 7.0, None, None, date(2025, 2, 1))]
    found = silver.waste_to_grain(spark.createDataFrame(rows, schema), by_load=True).collect()
    assert {(r.location_id, r.quantity_wasted, r.waste_reason, str(r.load_date)) for r in found} == {
        ("LOC001", 3.0, "plate waste", "2025-02-02"), (None, 7.0, None, "2025-02-01"),
    }


def test_only_the_sides_that_give_a_column_are_joined(spark):
    rows = [{}, {}, {"menu_item_id": "MI002", "category": None}, {"menu_item_id": None}, {"location_id": "LOC009", "quantity_prepared": 0.0}]
    feeds = {
        "production_logs": builders.production(spark, *rows),
        "waste_logs": builders.waste(spark, {}, {}, {"menu_item_id": "MI002", "quantity_wasted": None}, {"menu_item_id": None}),
        "menu_data": builders.menu(spark, "MI001", "MI001", "MI002"),
        "location_data": builders.locations(spark, "LOC001", "LOC002"),
    }
    asked = []

    def read(source):
        asked.append(source)
        df = feeds[source]
        return df.select(*(df[c].cast("string").alias(c) for c in df.columns))

    whole = batch.silver_from_bronze(read, lambda df: df, [*workspace._FEW["fact_waste"], "category", "city", "sub_category"])
    asked.clear()
    needs = {
        ("category",): ["production_logs"],
        ("city", "year"): ["production_logs", "location_data"],
        ("sub_category", "month"): ["production_logs", "menu_data"],
        ("waste_cost", "waste_percentage", "menu_item_id"): ["production_logs", "waste_logs"],
    }
    for columns, sources in needs.items():
        found = batch.silver_from_bronze(read, lambda df: df, columns)
        assert asked == sources
        asked.clear()
        assert sorted(found.collect(), key=str) == sorted(whole.select(*columns).collect(), key=str)


def test_waste_is_sorted_once_for_the_causes_of_a_key(spark, tmp_path):
    path = str(tmp_path / "waste")
    builders.waste(spark, {}, {"menu_item_id": "MI002"}).write.parquet(path)
    plan = silver.waste_to_grain(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    # Causes are dealt by key before they are sorted: below the last exchange nothing is.
    assert plan.count("Exchange") == 2
    assert "Sort" not in plan[plan.index("Exchange") :]


def test_logs_are_dealt_and_sorted_once_for_silver(spark, tmp_path, conf):
    """The run's Silver shuffles production once and sums of waste twice; the join of the two and the
    folders by month need neither another shuffle nor another sort of production."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    feeds = {"production_logs": builders.production(spark, {}, {"date": date(2025, 2, 1)}), "waste_logs": builders.waste(spark, {})}
    for name, df in feeds.items():
        texts = df.select(*(df[c].cast("string").alias(c) for c in df.columns), F.lit(date(2025, 3, 1)).alias("load_date"))
        texts.write.parquet(str(tmp_path / name))

    def read(name):
        return spark.read.parquet(str(tmp_path / name))

    months = spark.createDataFrame([(2025, 1), (2025, 2)], "year int, month int")
    columns = (*GRAIN, "quantity_prepared", "quantity_wasted", "year", "month")
    with batch.dealt_once(spark):
        built = batch.silver_of_months(read, months, lambda df: df, columns, buckets=4)
        plan = built.sortWithinPartitions("year", "month")._jdf.queryExecution().executedPlan().toString()
        rows = {(r.quantity_wasted, r.year, r.month) for r in built.collect()}
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan[: plan.index("Scan parquet")].count("Sort [") == 1
    assert rows == {(20.0, 2025, 1), (0.0, 2025, 2)}
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    plain = batch.silver_of_months(read, months, lambda df: df, columns)
    assert sorted(plain.collect()) == sorted(built.collect())
