import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from larder.operators import dims, facts, quality
from larder.plans import marts, registry, reports, workspace
from larder.schemas import DIMS, FACTS, MEAL_PERIODS, WASTE_REASONS
from larder.sources import bronze, testfeeds
from tests import builders

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

DAY2 = date(2025, 2, 1)


def suppliers(spark, *rows):
    schema = "supplier_sk string, menu_item_id string, quality_score double, is_current boolean"
    df = spark.createDataFrame(rows or [("SK1", "MI001", 4.0, True)], schema)
    return df.select(
        "supplier_sk", F.concat(F.lit("SUP-"), "supplier_sk").alias("supplier_id"),
        F.concat(F.lit("name "), "supplier_sk").alias("supplier_name"), "menu_item_id",
        F.lit("Pune").alias("supplier_city"), F.lit(3).alias("lead_time_days"), "quality_score",
        F.lit("2025-01-01").alias("effective_date"), F.lit("9999-12-31").alias("expiry_date"),
        "is_current",
    )


def gold_of(spark, silver, dim_supplier=None, pick="all"):
    tables = {
        "dim_date": dims.dim_date(spark, date(2025, 1, 1), date(2026, 12, 31)),
        "dim_category": dims.dim_category(silver),
        "dim_meal_period": dims.dim_meal_period(spark),
        "dim_waste_reason": dims.dim_waste_reason(spark),
        "dim_location": dims.dim_location(silver),
        "dim_menu": dims.dim_menu(silver),
        "dim_supplier": suppliers(spark) if dim_supplier is None else dim_supplier,
    }
    tables["fact_production"] = facts.fact_production(silver, tables)
    tables["fact_waste"] = facts.fact_waste(silver, tables, pick)
    tables["fact_consumption"] = facts.fact_consumption(silver, tables)
    tables["fact_waste_summary"] = facts.fact_waste_summary(silver, tables)
    return tables


PRODUCED = [
    {}, {"meal_period": "dinner"}, {"date": DAY2},
    {"menu_item_id": "MI002", "category": "SALADS", "menu_item_name": "Greens"},
    {"location_id": "LOC002", "location_name": "Annex"},
]
WASTED = [
    {"quantity_wasted": 45.0}, {"meal_period": "dinner", "quantity_wasted": 10.0},
    {"date": DAY2, "quantity_wasted": 60.0},
    {"menu_item_id": "MI002", "quantity_wasted": 25.0, "waste_reason": "spoilage"},
    {"location_id": "LOC002", "quantity_wasted": 4.0, "waste_reason": "plate waste"},
]


@pytest.fixture(scope="module")
def gold(spark):
    tables = gold_of(spark, builders.silver(spark, PRODUCED, WASTED).cache())
    return {name: df.cache() for name, df in tables.items()}


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_calendar(spark):
    days = dims.dim_date(spark, date(2025, 1, 1), date(2026, 12, 31))
    assert days.count() == 730
    saturday = days.where("date_sk = 20250104").first()
    assert (saturday.day_of_week, saturday.day_name, saturday.is_weekend) == (6, "Saturday", True)
    assert (saturday.month_name, saturday.quarter, saturday.full_date) == ("January", 1, "2025-01-04")
    quality.gate_unique(days, "date_sk")


def test_calendar_covers_whole_years(spark):
    df = spark.createDataFrame([(date(2024, 5, 5),), (date(2025, 2, 2),)], "date date")
    span = dims.dim_date_covering(df).agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert tuple(span) == ("2024-01-01", "2025-12-31", 731)
    assert dims.dim_date_covering(df.where("false")).count() == 0


def test_fixed_dimensions(spark):
    meals = dims.dim_meal_period(spark)
    assert {r.meal_period_name for r in meals.collect()} == set(MEAL_PERIODS)
    reasons = dims.dim_waste_reason(spark)
    assert {r.waste_reason_name for r in reasons.collect()} == set(WASTE_REASONS)
    assert rows(meals, "*") == rows(dims.dim_meal_period(spark), "*")


def test_categories_are_distinct_and_never_null(spark):
    silver = builders.silver(spark, [{"category": None}, {"category": " salads"}, {"category": "SALADS"}])
    assert rows(dims.dim_category(silver), "category_name") == [("SALADS",)]


def test_type1_keeps_known_keys_and_refreshes_attributes(spark):
    silver = builders.silver(spark, PRODUCED)
    known = spark.createDataFrame(
        [("OLD", "LOC001"), ("LEFT", "LOC999")], "location_sk string, location_id string"
    )
    built = {r.location_id: r for r in dims.dim_location(silver, known).collect()}
    assert set(built) == {"LOC001", "LOC002"}
    assert built["LOC001"].location_sk == "OLD"
    assert built["LOC002"].location_sk == dims.dim_location(silver).where(
        "location_id = 'LOC002'"
    ).first().location_sk


def test_type1_takes_the_latest_attributes(spark):
    silver = builders.silver(
        spark,
        [{"menu_item_name": "Old"}, {"date": DAY2, "menu_item_name": "New"}],
    )
    assert rows(dims.dim_menu(silver), "menu_item_name") == [("New",)]


def test_schemas(gold):
    for name, schema in {**DIMS, **FACTS}.items():
        assert gold[name].columns == schema.names, name
        assert [t for _, t in gold[name].dtypes] == [f.dataType.simpleString() for f in schema], name


def test_fact_checks_pass_and_fail(gold):
    for name in FACTS:
        quality.gate(gold[name], quality.fact_checks(name), "fail", name)
    broken = gold["fact_production"].withColumn("menu_sk", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match=r"\[fact_production\]: menu_sk_not_null — 5 rows"):
        quality.gate(broken, quality.fact_checks("fact_production"), "fail", "fact_production")
    no_cost = gold["fact_waste"].withColumn("waste_cost", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="waste_cost_gte_0"):
        quality.gate(no_cost, quality.fact_checks("fact_waste"), "fail")


def test_key_lookups_keep_the_rows_and_the_cost(spark, gold):
    silver = builders.silver(spark, PRODUCED, WASTED)
    assert gold["fact_production"].count() == silver.count()
    total = silver.where("waste_reason is not null").agg(F.sum("waste_cost")).first()[0]
    assert gold["fact_waste"].agg(F.sum("waste_cost")).first()[0] == total
    for name, key in (("fact_production", "production_sk"), ("fact_waste", "waste_sk")):
        quality.gate_unique(gold[name], key)


def test_two_suppliers_on_an_item(spark):
    silver = builders.silver(spark)
    two = suppliers(spark, ("A", "MI001", 3.0, True), ("B", "MI001", 4.0, True), ("C", "MI001", 5.0, False))
    both = gold_of(spark, silver, two)["fact_waste"]
    assert rows(both, "supplier_sk") == [("A",), ("B",)]
    quality.gate_unique(both, "waste_sk")
    best = gold_of(spark, silver, two, pick="best_quality")["fact_waste"]
    assert rows(best, "supplier_sk") == [("B",)]
    with pytest.raises(ValueError):
        facts.current_suppliers(two, "other")


def test_missing_supplier_and_missing_category(spark):
    silver = builders.silver(spark, [{"category": None}])
    gold = gold_of(spark, silver, suppliers(spark, ("A", "MI777", 3.0, True)))
    assert gold["fact_waste"].first().supplier_sk is None
    summary = gold["fact_waste_summary"].first()
    assert (summary.category, summary.category_sk) == ("UNKNOWN", None)


def test_summary(gold):
    found = rows(
        gold["fact_waste_summary"].where("category = 'MAIN COURSE'"),
        "month", "total_waste_quantity", "total_waste_cost", "avg_waste_percentage", "waste_event_count",
    )
    assert found == [(1, 4.0, 200.0, 4.0, 1), (1, 55.0, 2750.0, 27.5, 2), (2, 60.0, 3000.0, 60.0, 1)]


def test_month_over_month_is_per_location(gold):
    found = rows(marts.mom_by_location(gold, 2025), "location_name", "month", "total_waste_cost", "prev_month_cost")
    assert found == [("Annex", 1, 200.0, None), ("Campus Cafe", 1, 4000.0, None), ("Campus Cafe", 2, 3000.0, 4000.0)]
    change = marts.mom_by_location(gold, 2025).where("month = 2").first().mom_pct_change
    assert change == pytest.approx(-25.0)
    literal = rows(marts.mom_by_location_literal(gold, 2025).where("location_name = 'Campus Cafe'"), "month", "total_waste_cost", "prev_month_cost")
    assert literal == [(1, 1250.0, 2750.0), (1, 2750.0, None), (2, 3000.0, 1250.0)]


def test_period_limits(gold):
    assert marts.mom_by_location(gold, 2025, 2, 2).count() == 1
    assert marts.mom_by_location(gold, 2024).count() == 0


def test_equal_costs_share_a_rank(spark):
    produced = [{"menu_item_id": f"MI{i:03}", "menu_item_name": f"item {i}"} for i in range(5)]
    wasted = [{"menu_item_id": f"MI{i:03}", "quantity_wasted": q} for i, q in enumerate([9.0, 9.0, 7.0, 7.0, 5.0])]
    gold = gold_of(spark, builders.silver(spark, produced, wasted))
    assert rows(marts.top_menu_items(gold, 2025, n=2), "menu_item_name", "waste_rank") == [
        ("item 0", 1), ("item 1", 1), ("item 2", 2), ("item 3", 2)
    ]
    ranked = reports.top_items_by_category(gold, 2025, n=5)
    assert rows(ranked, "menu_item_name", "waste_rank")[-1] == ("item 4", 3)
    assert reports.top_items_by_category(gold, 2025, "NONE").count() == 0


def test_demand_gap_counts_two_meals_once(gold):
    plain = {r.category: r for r in marts.demand_gap(gold, 2025).collect()}
    assert plain["MAIN COURSE"].total_prepared == 400.0
    assert plain["MAIN COURSE"].total_consumed == 400.0 - 119.0
    paired = {r.category: r for r in marts.demand_gap_literal(gold, 2025).collect()}
    joined = gold["fact_production"].alias("p").join(
        gold["fact_consumption"].alias("c"), ["date_sk", "location_sk", "menu_sk"]
    ).join(gold["dim_menu"], "menu_sk").groupBy("category").agg(
        F.sum("p.quantity_prepared").alias("prepared"), F.sum("c.quantity_consumed").alias("consumed"),
        F.sum("c.demand_gap").alias("gap"),
    )
    for row in joined.collect():
        found = paired[row.category]
        assert (found.total_prepared, found.total_consumed, found.total_demand_gap) == (row.prepared, row.consumed, row.gap)
    assert paired["MAIN COURSE"].total_prepared > plain["MAIN COURSE"].total_prepared


def test_supplier_means(gold):
    df = marts.supplier_quality_vs_waste(gold, 2025)
    found = rows(df, "waste_percentage", "supplier_avg_waste_pct", "overall_avg_waste_pct")
    mean = (45.0 + 10.0 + 60.0 + 4.0) / 4
    assert found == [(v, mean, mean) for v in (4.0, 10.0, 45.0, 60.0)]


def test_reasons_by_meal(gold):
    january = marts.reason_by_meal(gold, 2025).where("month = 1")
    found = rows(january, "meal_period_name", "waste_reason_name", "event_count", "total_cost")
    assert found == [
        ("dinner", "overproduction", 1, 500.0), ("lunch", "overproduction", 1, 2250.0),
        ("lunch", "plate waste", 1, 200.0), ("lunch", "spoilage", 1, 1250.0),
    ]
    assert january.agg(F.sum("pct_of_monthly_total")).first()[0] == pytest.approx(100.0)
    literal = marts.reason_by_meal_literal(gold, 2025).where("month = 1")
    assert literal.count() == 3 * 4
    assert literal.agg(F.sum("pct_of_monthly_total")).first()[0] == pytest.approx(100.0)


@pytest.mark.parametrize(
    "category, percent, quantity, cause",
    [
        ("MAIN COURSE", 41.0, 6.0, "Overproduction"), ("SALADS", 41.0, 6.0, "Overproduction"),
        ("SALADS", 40.0, 6.0, "Storage / Spoilage"), ("DAIRY", 20.1, 1.0, "Storage / Spoilage"),
        ("DAIRY", 20.0, 1.0, "Low Demand"), ("MAIN COURSE", 31.0, 5.0, "Portion Mismatch"),
        ("MAIN COURSE", 31.0, 5.1, "Low Demand"), ("MAIN COURSE", 41.0, 5.0, "Portion Mismatch"),
        ("MAIN COURSE", 30.0, 1.0, "Low Demand"), ("Fruits", 25.0, 1.0, "Storage / Spoilage"),
    ],
)
def test_root_causes(spark, category, percent, quantity, cause):
    summary = spark.createDataFrame(
        [("L", "C", category, quantity, 1.0, percent, 1, 2025, 1)], FACTS["fact_waste_summary"]
    )
    place = spark.createDataFrame([("L", "id", "n", "c", "r", "t", "1", "A")], DIMS["dim_location"])
    gold = {"fact_waste_summary": summary, "dim_location": place}
    row = marts.root_cause(gold, 2025).first()
    assert row.root_cause == cause
    assert row.recommendation == marts.RECOMMENDATIONS[cause]
    short = reports.root_cause_filtered(gold, 2025).first()
    assert short.recommendation == reports.SHORT_RECOMMENDATIONS[cause]


def test_root_cause_view(spark, gold):
    marts.create_root_cause_view(gold, 2025)
    assert spark.sql("select count(*) from waste_root_cause").first()[0] == gold["fact_waste_summary"].count()


def test_reports(gold):
    monthly = {r.month_label: r for r in reports.kpi_monthly(gold, 2025).collect()}
    assert (monthly["Jan"].total_waste_cost, monthly["Feb"].total_waste_cost) == (4200.0, 3000.0)
    totals = reports.kpi_totals(gold, 2025).first()
    assert totals.total_waste_quantity == 144.0
    means = [monthly[m].avg_waste_percentage for m in ("Jan", "Feb")]
    assert totals.avg_waste_percentage == pytest.approx(sum(means) / 2)
    assert rows(reports.trend_mom(gold, 2025), "month", "prev_month_cost") == [(1, None), (2, 4200.0)]
    assert reports.trend_spikes(gold, 2025).count() == 0
    assert reports.trend_spikes(gold, 2025, above=-50).first().month_label == "Feb 2025"
    assert [r.location_name for r in reports.top_locations(gold, 2025).collect()] == ["Campus Cafe", "Annex"]
    assert rows(reports.location_trend_topn(gold, 2025, 1), "location_name", "month") == [("Campus Cafe", 1), ("Campus Cafe", 2)]
    assert reports.costliest_location(gold, 2025).first().location_name == "Campus Cafe"
    assert tuple(reports.commonest_reason(gold, 2025).first()) == ("overproduction", 3)
    assert reports.costliest_supplier(gold, 2025).first().supplier_id == "SUP-SK1"
    assert reports.worst_category(gold, 2025).first().category == "MAIN COURSE"
    assert reports.category_slice(gold, 2025, "salads").first().waste_event_count == 1
    assert [r.year for r in reports.available_years(gold).collect()] == [2025]
    assert reports.top_items_by_qty(gold, 2025).first().menu_item_name == "Dal Rice"
    assert rows(reports.root_cause_counts(gold, 2025), "group_count") == [(1,), (1,), (2,)]


def test_weighted_percentage(spark):
    silver = builders.silver(
        spark, [{}, {"meal_period": "dinner", "quantity_prepared": 300.0}],
        [{"quantity_wasted": 50.0}, {"meal_period": "dinner", "quantity_wasted": 30.0}],
    )
    row = reports.waste_pct_weighted(silver, 2025).first()
    assert (row.weighted_waste_pct, row.mean_waste_pct) == (20.0, 30.0)


def test_hot_location_is_split_by_the_key_lookups(spark, tmp_path, conf):
    """Half of Silver at one location: the shuffled lookup splits it, and loses no row."""
    produced = [{}, {"menu_item_id": "MI002", "category": "SALADS", "menu_item_name": "Greens"}]
    few = builders.silver(spark, produced, [{}])
    silver = few.crossJoin(spark.range(0, 20000, 1, 6)).withColumn(
        "location_id", F.when(F.col("id") % 2 == 0, "LOC001").otherwise(F.concat(F.lit("L"), "id"))
    ).drop("id")
    silver.repartition(6).write.parquet(str(tmp_path / "silver"))
    silver = spark.read.parquet(str(tmp_path / "silver"))
    tables = {
        "dim_date": dims.dim_date(spark, date(2025, 1, 1), date(2025, 12, 31)),
        "dim_location": dims.dim_location(silver), "dim_menu": dims.dim_menu(silver),
        "dim_meal_period": dims.dim_meal_period(spark),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    fact = facts.fact_production(silver, tables)
    assert "skew=true" in builders.final_plan(fact)
    assert fact.where("location_sk is not null and menu_sk is not null").count() == 40000


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_reports_on_landed_feeds_only_land_feeds(spark, monkeypatch):
    """what is asked of Bronze needs no Silver and no facts."""

    def refuse(*_args, **_kwargs):
        raise AssertionError("built more than Bronze")

    for name in ("run", "run_silver", "run_facts"):
        monkeypatch.setattr(registry.batch, name, refuse)
    landed = workspace.Workspace(spark, SF_DIR)
    counted = {r.source: (r.files, r.row_count) for r in registry.BUILDERS["bronze_source_files"](landed).collect()}
    assert {files for files, _ in counted.values()} == {2}
    held = registry.BUILDERS["bronze_month_index"](landed).collect()
    assert {r.month for r in held if r.read_again and r.load_date == "1998-01-01"} == {registry.AGAIN}


def test_a_feed_of_two_files_holds_every_record_once(spark, tmp_path):
    rows = spark.range(500).selectExpr("cast(id % 100 as string) as a", 'concat(\'x"\', id) as b')
    testfeeds.write_csv_feed(rows, f"{tmp_path}/two", files=2)
    testfeeds.write_csv_feed(rows, f"{tmp_path}/packed", packed=True)
    for name in ("two", "packed"):
        back = bronze.read_csv(spark, f"{tmp_path}/{name}")
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert len([f for f in os.listdir(f"{tmp_path}/two") if f.endswith(".csv")]) == 2


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_reports_over_facts_store_neither_silver_nor_facts(spark):
    """they read few columns, so the whole rows are not shuffled by month and stored."""
    for name in ("dq_fact_report", "fact_key_report", "table_counts", "silver_two_loads"):
        opened = workspace.Workspace(spark, SF_DIR)
        registry.BUILDERS[name](opened)
        assert not {"silver", *FACTS} & set(opened._stored), name


def _driver_tables(spark, folder):
    """Few rows of the driver's tables, with one part that two suppliers carry."""
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "R")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "N1", 0), (2, "N2", 0)]),
        "customer": ("c_custkey long, c_nationkey int", [(1, 1), (2, 2)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(8, "S8", 1, 5.0), (9, "S9", 1, 6.0), (2, "S2", 2, 7.0)]),
        "part": (
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
            [(8, "eight", "B", "SMALL", 3, 10.0), (2, "two", "B", "LARGE", 4, 20.0), (5, "five", "B", "PROMO", 4, 30.0)],
        ),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string",
            [(k, 1 + k % 2, "F", datetime(1996 + k % 2, 1 + k % 3, 5), f"{1 + k % 5}-X") for k in range(12)],
        ),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string",
            [(k, p, 8, p % 4, 10.0 + k, 0.05 * (1 + k % 2), 0.01, "R" if k % 4 else "N") for k in range(12) for p in (8, 2, 5)],
        ),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_marts_of_few_columns_store_no_fact(spark, tmp_path):
    """Neither the waste fact nor the dimensions that the question does not show are built for it."""
    folder = _driver_tables(spark, tmp_path)
    for query, columns in (("top_menu_items", registry.ITEM_COLUMNS), ("supplier_quality_vs_waste", registry.SUPPLIER_COLUMNS)):
        w = workspace.Workspace(spark, folder)
        found = sorted(map(str, registry.BUILDERS[query](w).collect()))
        assert found and not {"fact_waste", "silver", "dim_date", "dim_location"} & w._stored.keys()
        few = sorted(map(str, w.waste_of(registry.YEAR, *columns)["fact_waste"].collect()))
        whole = w["fact_waste"].where(F.col("year") == registry.YEAR)
        assert few and few == sorted(map(str, whole.select(*columns).collect()))
        assert found == sorted(map(str, registry.BUILDERS[query](w).collect()))
        w.stage.drop()


def test_feeds_do_not_shuffle_rows_for_the_parts(spark, tmp_path, conf):
    """A table of parts above Spark's own threshold, but small enough to be sent: the rows of the logs
    are shuffled for orders and keys only."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    folder = _driver_tables(spark, tmp_path)
    orders = testfeeds.order_keys(spark, folder)
    for feed in (testfeeds.production_logs, testfeeds.waste_logs):
        plan = feed(spark, folder, orders)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(l_partkey" not in plan


def test_lines_are_dealt_by_key_before_they_are_summed(spark, tmp_path, monkeypatch):
    """no task sums a whole split of lines; tasks grow in number with the lines, and the sums stay."""
    monkeypatch.setattr(testfeeds, "LINES_OF_TASK", 4, raising=False)
    folder = _driver_tables(spark, tmp_path)
    logs = testfeeds.production_logs(spark, folder, testfeeds.order_keys(spark, folder))
    plan = logs._jdf.queryExecution().executedPlan().toString()
    dealt = plan.index("REPARTITION_BY_NUM")
    assert plan.index("sum(") < plan.index("partial_sum(") < dealt
    assert f"{36 // 4}), REPARTITION_BY_NUM" in plan
    assert plan.count("hashpartitioning(date") == 1
    found = sorted(float(r.quantity_prepared) for r in logs.collect())
    # Orders 3 and 9 are one key: both priorities are snacks.
    assert found == sorted(3 * [10.0 + k for k in range(12) if k not in (3, 9)] + 3 * [32.0])


def test_large_order_keys_are_not_broadcast(spark, tmp_path, monkeypatch):
    """packed files below Spark's threshold may hold many rows; few rows are sent all the same."""
    folder = _driver_tables(spark, tmp_path)
    orders = testfeeds.order_keys(spark, folder)
    orders.write.parquet(f"{folder}/order_keys")
    orders = spark.read.parquet(f"{folder}/order_keys")
    rows = {}
    for most, join in ((11, "SortMergeJoin [l_orderkey"), (12, "BroadcastHashJoin [l_orderkey")):
        monkeypatch.setattr("larder.sources.tables.MOST_SENT", most)
        for feed in (testfeeds.production_logs, testfeeds.waste_logs):
            logs = feed(spark, folder, orders)
            assert join in logs._jdf.queryExecution().executedPlan().toString()
            found = sorted(map(str, logs.collect()))
            assert found and found == rows.setdefault(feed, found)


def test_the_report_on_suppliers_stores_neither_silver_nor_the_waste(spark, tmp_path):
    """it counts rows, so few columns of Silver are stored, and nothing is shuffled by month."""
    w = workspace.Workspace(spark, _driver_tables(spark, tmp_path))
    found = [tuple(r) for r in registry.BUILDERS["supplier_fanout_report"](w).collect()]
    plain = {q: sorted(map(str, registry.BUILDERS[q](w).collect())) for q in ("supplier_as_of", "fact_waste_best_quality")}
    assert not {"silver", *FACTS} & w._stored.keys()
    before = w.silver().where("waste_reason is not null").count()
    assert found == [(before, w["fact_waste"].count(), 1)] and before < found[0][1]
    for query, rows_of in plain.items():
        assert rows_of and rows_of == sorted(map(str, registry.BUILDERS[query](w).collect()))
    w.stage.drop()


def test_the_checks_on_silver_do_not_store_all_of_it(spark, tmp_path):
    """ten columns are checked; the menu and the locations are not joined for them."""
    w = workspace.Workspace(spark, _driver_tables(spark, tmp_path))
    found = {(r.case_name, r.check_name): r.failing_rows for r in registry.BUILDERS["dq_silver_report"](w).collect()}
    assert not {"silver", "menu_data", "location_data"} & w._stored.keys()
    whole = {r.check_name: r.failing_rows for r in quality.report(w.silver(), quality.silver_checks()).collect()}
    assert {check: rows for (case, check), rows in found.items() if case == "silver"} == whole
    assert len(found) == 20
    w.stage.drop()


def test_type1_upserts_read_no_waste(spark, tmp_path):
    """F8: attributes of locations and items need production and one side; all of Silver is not stored."""
    w = workspace.Workspace(spark, _driver_tables(spark, tmp_path))
    few = {q: sorted(map(str, registry.BUILDERS[q](w).collect())) for q in ("scd1_location", "scd1_menu")}
    assert not {"silver", "waste_logs"} & w._stored.keys()
    w.silver()
    for query, rows_of in few.items():
        assert rows_of and rows_of == sorted(map(str, registry.BUILDERS[query](w).collect()))
    w.stage.drop()


#: The marts that ask the facts about one year.
ONE_YEAR = ("demand_gap", "mom_by_location", "reason_by_meal", "root_cause", "waste_pct_weighted")


def test_marts_of_one_year_store_no_facts(spark, tmp_path):
    """the rows of the year are stored once in few columns, and the facts are planned over them."""
    folder = _driver_tables(spark, tmp_path)
    few, whole = workspace.Workspace(spark, folder), workspace.Workspace(spark, folder)
    whole.silver()
    for name in FACTS:
        whole[name]
    for query in ONE_YEAR:
        found = sorted(map(str, registry.BUILDERS[query](few).collect()))
        assert found and found == sorted(map(str, registry.BUILDERS[query](whole).collect())), query
    assert not {"silver", *FACTS} & few._stored.keys()
    assert [r.year for r in few.silver_of_facts(registry.YEAR).select("year").distinct().collect()] == [registry.YEAR]
    few.stage.drop()
    whole.stage.drop()


def test_marts_as_shown_share_the_rows_of_their_year(spark, tmp_path, monkeypatch):
    """the logs are joined once for the six marts, not once for every fact and mart."""
    w = workspace.Workspace(spark, _driver_tables(spark, tmp_path))
    joined = []
    build = workspace.silver_from_bronze
    monkeypatch.setattr(workspace, "silver_from_bronze", lambda read, stage, columns, year: joined.append(columns) or build(read, stage, columns, year))
    assert {r.mart for r in registry.BUILDERS["display_orders"](w).collect()} == set(registry.SHOWN)
    assert sum("quantity_wasted" in columns for columns in joined) == 1
    assert not {"silver", *FACTS} & w._stored.keys()
    w.stage.drop()
