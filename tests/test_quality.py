import pytest
from pyspark.sql import functions as F

from larder.operators import quality
from larder.operators.quality import QualityError

GATE = "id string, quantity_wasted double, quantity_prepared double, waste_pct double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), GATE)


GOOD = ("A", 10.0, 100.0, 10.0)


@pytest.mark.parametrize(
    "bad, name, condition",
    [
        (("B", None, 80.0, None), "present", "quantity_wasted is not null"),
        (("B", 90.0, 80.0, 112.5), "range", "waste_pct between 0 and 100"),
        (("B", 110.0, 100.0, 110.0), "lte", "quantity_wasted <= quantity_prepared"),
    ],
)
def test_gate_raises(spark, bad, name, condition):
    with pytest.raises(QualityError, match=f"DQ GATE FAILED: {name} — 1 rows"):
        quality.gate(frame(spark, GOOD, bad), [(name, F.expr(condition))])


def test_gate_passes(spark):
    checks = [
        ("present", F.col("quantity_wasted").isNotNull()),
        ("range", F.col("waste_pct").between(0, 100)),
    ]
    quality.gate(frame(spark, GOOD, ("B", 20.0, 80.0, 25.0)), checks)


def test_no_checks_pass(spark):
    quality.gate(frame(spark, GOOD), [])


def test_first_failing_check_in_list_order_is_named(spark):
    checks = [("fine", F.lit(True)), ("second", F.lit(False)), ("third", F.lit(False))]
    with pytest.raises(QualityError, match="second"):
        quality.gate(frame(spark, GOOD), checks)


def test_null_condition_under_both_rules(spark):
    df = frame(spark, ("A", None, 100.0, None), ("B", 200.0, 100.0, 10.0))
    checks = [("lte", F.col("quantity_wasted") <= F.col("quantity_prepared"))]
    counts = {n: quality.report(df, checks, n).first().failing_rows for n in ("pass", "fail")}
    assert counts == {"pass": 1, "fail": 2}
    with pytest.raises(ValueError):
        quality.report(df, checks, "other")


def test_all_checks_are_counted_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, GOOD).write.parquet(path)
    checks = [(f"c{i}", F.col("waste_pct") > i) for i in range(10)]
    plan = quality.report(spark.read.parquet(path), checks)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_unique_gate(spark):
    df = frame(spark, GOOD, GOOD, GOOD, ("B", 1.0, 1.0, 1.0))
    assert quality.unique_report(df, "id").first().failing_rows == 2
    with pytest.raises(QualityError, match="unique_id"):
        quality.gate_unique(df, "id")
    quality.gate_unique(df.where("id = 'B'"), "id")


def test_bronze_report(spark):
    df = frame(spark, GOOD, (None, 1.0, 1.0, 1.0))
    found = {r.check_name: r.failing_rows for r in quality.key_nulls_report(df, ["id"]).collect()}
    assert found == {"not_empty": 0, "id_not_null": 1}
    empty = quality.key_nulls_report(df.where("false"), ["id"])
    with pytest.raises(QualityError, match="not_empty"):
        quality.raise_on_failure(empty)


def test_marts_are_shown_in_order(spark):
    from larder.plans import reports

    def shown(name, rows, schema, column=0):
        return [r[column] for r in reports.in_display_order(spark.createDataFrame(rows, schema), name).collect()]

    assert shown("top_menu_items", [("b", 2), ("a", 2), ("c", 1), (None, 1)], "menu_item_name string, waste_rank int") == ["c", None, "a", "b"]
    assert shown("demand_gap", [(-5.0,), (1.0,), (None,), (3.0,)], "total_demand_gap double") == [3.0, 1.0, -5.0, None]
    rows = [("a", 2.0, 1.0), ("b", 1.0, 1.0), ("c", 1.0, 9.0)]
    assert shown("supplier_quality_vs_waste", rows, "supplier_name string, quality_score double, waste_percentage double") == ["c", "b", "a"]
    rows = [("lunch", "a", 1.0), ("lunch", "b", 5.0), ("dinner", "c", 0.0)]
    assert shown("reason_by_meal", rows, "meal_period_name string, waste_reason_name string, total_cost double", 1) == ["c", "b", "a"]
    rows = [(2, "x", 10.0), (1, "y", 30.0), (3, "z", None)]
    assert shown("root_cause", rows, "month int, location_name string, waste_percentage double", 1) == ["y", "x", "z"]
    rows = [("b", 1997, 1), ("a", 1997, 2), ("a", 1997, 1)]
    assert shown("mom_by_location", rows, "location_name string, year int, month int", 2) == [1, 2, 1]
    with pytest.raises(Exception, match="waste_percentage"):
        shown("root_cause", [(1,)], "month int")


def test_sums_leave_nothing_out(spark, conf):
    from larder.functions.measures import exact_sum

    cases = {"small": [0.00004] * 1000, "nan": [1.0, float("nan")], "inf": [1.0, float("inf")], "large": [1e15, 1.0], "huge": [1e30, 1.0], "none": [None, None]}
    rows = [(k, v) for k, values in cases.items() for v in values]
    for ansi in ("true", "false"):
        conf(spark__sql__ansi__enabled=ansi)
        df = spark.createDataFrame(rows, "k string, v double")
        found = dict(df.groupBy("k").agg(exact_sum("v").alias("s")).collect())
        assert found["small"] == 0.04 and found["large"] == 1e15 + 1 and found["huge"] == 1e30
        assert str(found["nan"]) == "nan" and found["inf"] == float("inf") and found["none"] is None


def test_keys_tell_parts_apart(spark):
    from larder.functions.text import surrogate_key

    parts = [("a|b", "c"), ("a", "b|c"), ("a\\|b", "c"), ("a", None), ("a", ""), (None, "a"), ("a", "\\N")]
    df = spark.createDataFrame(parts, "x string, y string").select(surrogate_key("x", "y").alias("k"))
    assert df.distinct().count() == len(parts)


def test_raw_waste_is_not_sorted(spark):
    from larder.operators import silver

    kind = "date date, location_id string, menu_item_id string, meal_period string, quantity_wasted double, waste_reason string, waste_stage string"
    plan = silver.waste_to_grain(spark.createDataFrame([], kind))._jdf.queryExecution().executedPlan().toString()
    raw = plan[plan.index("functions=[partial_sum"):]
    assert "HashAggregate" in plan and "SortAggregate" not in raw


def test_unique_gate_tells_keys_of_one_hash_apart(spark):
    # Nulls do not enter the hash: only the keys themselves tell these rows apart.
    rows = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    quality.gate_unique(rows, "x", "y")
    with pytest.raises(quality.QualityError, match="unique_x_y — 1 rows"):
        quality.gate_unique(rows.union(rows.limit(1)), "x", "y")
