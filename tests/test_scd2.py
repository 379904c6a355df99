from datetime import date

import pytest

from larder.operators import quality, scd2
from larder.schemas import DIMS

TODAY = date(2025, 6, 1)
DIM = DIMS["dim_supplier"]
INCOMING = (
    "supplier_id string, supplier_name string, menu_item_id string, supplier_city string, "
    "lead_time_days int, quality_score double"
)


def incoming(spark, *rows):
    default = {
        "supplier_id": "SUP001", "supplier_name": "Fresh Farms", "menu_item_id": "MI001",
        "supplier_city": "Pune", "lead_time_days": 3, "quality_score": 4.5,
    }
    return spark.createDataFrame([{**default, **r} for r in rows or ({},)], INCOMING)


def existing(spark, *rows):
    default = {
        "supplier_sk": "SK-EXISTING", "supplier_id": "SUP001", "supplier_name": "Fresh Farms",
        "menu_item_id": "MI001", "supplier_city": "Pune", "lead_time_days": 3,
        "quality_score": 4.5, "effective_date": "2025-01-01", "expiry_date": "9999-12-31",
        "is_current": True,
    }
    return spark.createDataFrame([{**default, **r} for r in rows or ({},)], DIM)


def by_sk(df):
    rows = df.collect()
    found = {r.supplier_sk: r for r in rows}
    assert len(found) == len(rows)
    return found


def test_first_load(spark):
    rows = scd2.apply_scd2(None, incoming(spark), TODAY).collect()
    assert len(rows) == 1
    assert rows[0].is_current
    assert (rows[0].effective_date, rows[0].expiry_date) == ("2025-06-01", "9999-12-31")


def test_change_closes_and_opens(spark):
    found = by_sk(scd2.apply_scd2(existing(spark), incoming(spark, {"quality_score": 3.8}), TODAY))
    assert len(found) == 2
    old = found.pop("SK-EXISTING")
    assert (old.is_current, old.expiry_date) == (False, "2025-05-31")
    new = next(iter(found.values()))
    assert (new.is_current, new.quality_score, new.effective_date) == (True, 3.8, "2025-06-01")


def test_no_change_keeps_the_row(spark):
    assert list(by_sk(scd2.apply_scd2(existing(spark), incoming(spark), TODAY))) == ["SK-EXISTING"]


@pytest.mark.parametrize("score", [2.0, 4.5])
def test_one_current_row(spark, score):
    df = scd2.apply_scd2(existing(spark), incoming(spark, {"quality_score": score}), TODAY)
    assert df.where("is_current").count() == 1
    quality.gate_versions(df)


def test_gate_on_two_current(spark):
    bad = existing(
        spark, {"supplier_sk": "SK1"}, {"supplier_sk": "SK2", "effective_date": "2025-03-01"}
    )
    with pytest.raises(ValueError, match="one_current_per_supplier"):
        quality.gate_versions(bad)


def test_gate_on_duplicate_key(spark):
    bad = existing(
        spark,
        {"supplier_sk": "SK1", "expiry_date": "2025-05-31", "is_current": False},
        {"supplier_sk": "SK1", "effective_date": "2025-06-01"},
    )
    with pytest.raises(ValueError, match="unique_supplier_sk"):
        quality.gate_versions(bad)


def versions(spark, *spans):
    rows = [
        {"supplier_sk": f"S{i}", "effective_date": a, "expiry_date": b, "is_current": False}
        for i, (a, b) in enumerate(spans)
    ]
    return existing(spark, *rows)


@pytest.mark.parametrize(
    "spans, overlaps",
    [
        ([("2025-01-01", "2025-03-01"), ("2025-03-02", "9999-12-31")], 0),
        ([("2025-01-01", "2025-03-02"), ("2025-03-02", "9999-12-31")], 1),
        ([("2023-01-01", "2025-03-01"), ("2025-01-15", "9999-12-31")], 1),
        ([("2020-01-01", "2020-12-31"), ("2023-01-01", "2023-12-31"), ("2024-01-01", "9999-12-31")], 0),
        ([("2025-01-01", "2024-01-01"), ("2025-01-01", "9999-12-31")], 0),
    ],
)
def test_overlaps_within_and_across_years(spark, spans, overlaps):
    for order in (spans, spans[::-1]):
        assert quality.overlapping_versions(versions(spark, *order)).count() == overlaps


def test_overlaps_match_a_plain_walk(spark):
    """Against brute force over one entity with many versions."""
    import random

    rng = random.Random(7)
    days = [date.fromordinal(date(2015, 1, 1).toordinal() + rng.randrange(3650)) for _ in range(120)]
    spans = [
        (d.isoformat(), date.fromordinal(d.toordinal() + rng.randrange(60)).isoformat()) for d in days
    ]
    rows = sorted((a, b, f"S{i}") for i, (a, b) in enumerate(spans))
    expected = sum(1 for before, row in zip(rows, rows[1:]) if before[1] >= row[0])
    assert quality.overlapping_versions(versions(spark, *spans)).count() == expected > 0


def test_null_in_a_tracked_column_is_no_change(spark):
    df = scd2.apply_scd2(
        existing(spark, {"lead_time_days": None}), incoming(spark, {"lead_time_days": None}), TODAY
    )
    assert df.count() == 1
    changed = scd2.apply_scd2(existing(spark, {"lead_time_days": None}), incoming(spark), TODAY)
    assert changed.count() == 2


def test_second_run_on_a_day_replaces_in_place(spark):
    first = scd2.apply_scd2(existing(spark), incoming(spark, {"quality_score": 3.0}), TODAY)
    second = scd2.apply_scd2(first, incoming(spark, {"quality_score": 2.0}), TODAY)
    quality.gate_versions(second)
    assert second.count() == 2
    assert second.where("is_current").first().quality_score == 2.0


def test_merging_twice_changes_nothing(spark):
    batch = incoming(spark, {"quality_score": 3.0}, {"supplier_id": "SUP002"})
    once = scd2.apply_scd2(existing(spark), batch, TODAY)
    twice = scd2.apply_scd2(once, batch, TODAY)
    assert by_sk(once) == by_sk(twice)


def test_absent_stays_and_closed_only_returns(spark):
    dim = existing(
        spark, {"supplier_id": "GONE", "supplier_sk": "G"},
        {"supplier_id": "BACK", "supplier_sk": "B", "expiry_date": "2025-02-01", "is_current": False},
    )
    found = by_sk(scd2.apply_scd2(dim, incoming(spark, {"supplier_id": "BACK"}), TODAY))
    assert found["G"].is_current and not found["B"].is_current
    assert len(found) == 3


def test_duplicate_incoming_ids_give_one_version(spark):
    batch = incoming(spark, {"supplier_name": "B"}, {"supplier_name": "A"})
    rows = scd2.apply_scd2(None, batch, TODAY).collect()
    assert [r.supplier_name for r in rows] == ["A"]


def test_untracked_column_is_left_unless_asked(spark):
    batch = incoming(spark, {"supplier_city": "Delhi"})
    kept = scd2.apply_scd2(existing(spark), batch, TODAY).first()
    assert kept.supplier_city == "Pune"
    refreshed = scd2.apply_scd2(existing(spark), batch, TODAY, overwrite=["supplier_city"]).collect()
    assert [(r.supplier_sk, r.supplier_city) for r in refreshed] == [("SK-EXISTING", "Delhi")]


RECORDS = (
    "supplier_record_id string, supplier_id string, supplier_name string, menu_item_id string, "
    "supplier_city string, lead_time_days string, quality_score string, effective_from string, "
    "is_current string, ingestion_timestamp string"
)


def record(n, sid, name, since, flag, lead="3", quality_score="4.0"):
    return (f"R{n}", sid, name, "MI1", "C", lead, quality_score, since, flag, "t")


def test_latest_supplier_records(spark):
    rows = [
        record(1, " S1 ", "old", "2024-01-01", "1"),
        record(2, "S1", "new", "2024-06-01", "True"),
        record(3, "S1", "not current", "2025-01-01", "0"),
        record(4, "S2", "undated", "bad", "1.0", lead="x", quality_score="y"),
        record(5, None, "no id", "2024-01-01", "1"),
        record(6, "S3", "never current", "2024-01-01", "False"),
    ]
    found = {r.supplier_id: r for r in scd2.latest_suppliers(spark.createDataFrame(rows, RECORDS)).collect()}
    assert {k: v.supplier_name for k, v in found.items()} == {"S1": "new", "S2": "undated"}
    assert (found["S2"].lead_time_days, found["S2"].quality_score) == (None, None)


def test_all_records_count_if_none_is_current(spark):
    rows = [record(1, "S1", "a", "2024-01-01", "0"), record(2, "S1", "b", "2024-02-01", None)]
    assert scd2.latest_suppliers(spark.createDataFrame(rows, RECORDS)).first().supplier_name == "b"


def test_feed_without_optional_columns(spark):
    rows = spark.createDataFrame([record(1, "S1", "a", "x", "0")], RECORDS).drop(
        "is_current", "effective_from", "ingestion_timestamp"
    )
    assert scd2.latest_suppliers(rows).count() == 1


def test_as_of_lookup(spark):
    dim = existing(
        spark,
        {"supplier_sk": "OLD", "expiry_date": "2025-05-31", "is_current": False},
        {"supplier_sk": "NEW", "effective_date": "2025-06-01"},
    )
    rows = spark.createDataFrame(
        [(date(2025, 5, 31), "MI001"), (date(2025, 6, 1), "MI001"), (date(2024, 1, 1), "MI001")],
        "date date, menu_item_id string",
    )
    found = {r.date.isoformat(): r.supplier_sk for r in scd2.supplier_as_of(rows, dim).collect()}
    assert found == {"2025-05-31": "OLD", "2025-06-01": "NEW", "2024-01-01": None}




SNAPSHOT = f"load_date date, {INCOMING}"
DAYS = [date(2025, 1, 1), date(2025, 2, 1), date(2025, 2, 1 + 14)]


def snapshots():
    """Three snapshots: changed and changed back, changed once, never, absent in the middle, new at
    the end, with null tracked columns, with another city only."""
    def row(day, supplier, score=4.5, lead=3, city="Pune", name="Fresh Farms"):
        return (DAYS[day], supplier, name, "MI001", city, lead, score)

    return [
        row(0, "A"), row(1, "A", 3.0), row(2, "A"),
        row(0, "B"), row(1, "B", lead=5), row(2, "B", lead=5),
        row(0, "C"), row(1, "C"), row(2, "C", city="Delhi"),
        row(0, "D"), row(2, "D", 2.0),
        row(2, "E"),
        row(0, "F", None), row(1, "F", None), row(2, "F", 1.0),
        row(0, "G", name=" Farm "), row(1, "G", name="Farm"), row(2, "G", name="Farm"),
        row(0, "H"),
    ]


def versions_of(df):
    return sorted(map(tuple, df.select(*DIM.names).collect()), key=str)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
def test_history_of_all_snapshots_equals_merges_in_order(spark, order):
    """Whatever the order in which the three arrive."""
    arrived = [r for k in order for r in snapshots() if r[0] == DAYS[k]]
    found = scd2.history(spark.createDataFrame(arrived, SNAPSHOT))
    merged = None
    for day in DAYS:
        one = spark.createDataFrame([r for r in snapshots() if r[0] == day], SNAPSHOT).drop("load_date")
        merged = scd2.apply_scd2(merged, one, day)
        merged = spark.createDataFrame(merged.collect(), DIM)
    assert versions_of(found) == versions_of(merged)
    quality.gate_versions(found)
    by_supplier = {s: sum(r.supplier_id == s for r in found.collect()) for s in "ABCDEFGH"}
    assert by_supplier == {"A": 3, "B": 2, "C": 1, "D": 2, "E": 1, "F": 2, "G": 1, "H": 1}


def test_history_without_snapshots(spark):
    assert scd2.history(spark.createDataFrame([], SNAPSHOT)).count() == 0


def test_latest_records_of_each_load(spark):
    """A load without any current flag counts whole; in others only flagged records do."""
    columns = "load_date date, supplier_id string, quality_score string, is_current string, effective_from string, lead_time_days string"
    rows = [(*r, "1") for r in [
        (DAYS[0], "A", "1", "0", "2024-01-01"), (DAYS[0], "A", "2", "0", "31/12/2024 nonsense"), (DAYS[0], "B", "3", None, None),
        (DAYS[1], "A", "4", "1", "March 5, 2024"), (DAYS[1], "A", "5", "1", "2024-03-04"), (DAYS[1], "B", "6", "0", "2024-01-01"),
    ]]
    found = scd2.latest_suppliers(spark.createDataFrame(rows, columns), by_load=True)
    assert sorted((r.load_date, r.supplier_id, r.quality_score) for r in found.collect()) == [
        (DAYS[0], "A", 1.0), (DAYS[0], "B", 3.0), (DAYS[1], "A", 4.0),
    ]


@pytest.mark.parametrize(
    "text, day",
    [
        ("2025-01-31", (2025, 1, 31)), ("2025-1-3", (2025, 1, 3)), ("2025-01-31 10:11:12", (2025, 1, 31)), ("2025-01-31T10:11", (2025, 1, 31)),
        ("2025/01/31", (2025, 1, 31)), ("01/31/2025", (2025, 1, 31)), ("1/2/2025", (2025, 1, 2)), ("31 Jan 2025", (2025, 1, 31)),
        ("31-Jan-2025", (2025, 1, 31)), ("Jan 31, 2025", (2025, 1, 31)), ("January 31, 2025", (2025, 1, 31)), ("20250131", (2025, 1, 31)),
        ("2025-13-01", None), ("31/31/2025", None), ("soon", None), ("", None), (None, None),
    ],
)
def test_days_in_any_form(spark, text, day):
    from larder.functions.text import to_any_day

    found = spark.createDataFrame([(text,)], "t string").select(to_any_day("t").alias("d")).first().d
    assert found == (date(*day) if day else None)
