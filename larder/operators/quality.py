"""Data-quality checks. Every rule has a report (a DataFrame) and a gate (raises)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from larder.functions.measures import in_range
from larder.schemas import SILVER, WASTE_REASONS

Check = tuple[str, Column]


class QualityError(ValueError):
    """A gate found rows that break a rule."""


def _failures(condition: Column, nulls: str) -> Column:
    if nulls not in ("pass", "fail"):
        raise ValueError("nulls must be 'pass' or 'fail'")
    # A condition that is null is neither kept nor rejected by a filter; ``nulls`` decides.
    return F.count_if(F.coalesce(~condition, F.lit(nulls == "fail")))


def _long_form(one_row: DataFrame, names: Sequence[str]) -> DataFrame:
    pairs = [
        F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("failing_rows"))
        for i, n in enumerate(names)
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def failures(checks: Sequence[Check], nulls: str = "pass") -> dict[str, Column]:
    """The failing rows of each check as an aggregate."""
    return {name: _failures(condition, nulls) for name, condition in checks}


class Watch:
    """Aggregates over rows that something else reads or writes, without a pass of their own."""

    def __init__(self, columns: Mapping[str, Column]):
        self.columns = dict(columns)
        self.observation = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        """``df``, to be read or written once, whole."""
        if not self.columns:
            return df
        return df.observe(self.observation, *(c.alias(name) for name, c in self.columns.items()))

    def values(self) -> dict:
        """What was found, once that is done."""
        found = self.observation.get if self.columns else {}
        return {name: found[name] for name in self.columns}


def raise_on_counts(found: Mapping[str, int], table: str = "") -> None:
    """Raise for the first check, in order, that any row fails."""
    where = f" [{table}]" if table else ""
    for name, rows in found.items():
        if rows:
            raise QualityError(f"DQ GATE FAILED{where}: {name} — {rows} rows")


def report(df: DataFrame, checks: Sequence[Check], nulls: str = "pass") -> DataFrame:
    """check_name, failing_rows: all checks counted in one pass over ``df``."""
    counts = [_failures(cond, nulls).alias(f"c{i}") for i, (_, cond) in enumerate(checks)]
    return _long_form(df.agg(*counts), [name for name, _ in checks])


def raise_on_failure(found: DataFrame, table: str = "") -> None:
    """Raise for the first failing check of a report; reports hold one row per check."""
    raise_on_counts({row.check_name: row.failing_rows for row in found.collect()}, table)


def gate(df: DataFrame, checks: Sequence[Check], nulls: str = "pass", table: str = "") -> None:
    """Stop at the first check, in list order, that any row fails."""
    if checks:
        raise_on_failure(report(df, checks, nulls), table)


# --- Bronze ---------------------------------------------------------------------------


def key_nulls(key: Sequence[str]) -> dict[str, Column]:
    """No rows at all, and nulls per key column, as aggregates."""
    empty = F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint")
    return {"not_empty": empty, **{f"{c}_not_null": F.count_if(F.col(c).isNull()) for c in key}}


def key_nulls_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows present and nulls per key column, in one pass."""
    counts = key_nulls(key)
    columns = [c.alias(f"c{i}") for i, c in enumerate(counts.values())]
    return _long_form(df.agg(*columns), list(counts))


# --- Uniqueness -----------------------------------------------------------------------


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys on more than one row, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def unique_report(df: DataFrame, *key: str) -> DataFrame:
    """Surplus rows: all rows of a key but one."""
    surplus = F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("c0")
    return _long_form(duplicate_keys(df, *key).agg(surplus), [f"unique_{'_'.join(key)}"])


def gate_unique(df: DataFrame, *key: str, table: str = "") -> None:
    """Raise if a key is on several rows. Equal keys have equal hashes, so only hashes are shuffled;
    where one is there twice, the keys themselves are counted."""
    hashes = df.select(F.xxhash64(*key).alias("_hash"))
    if not duplicate_keys(hashes, "_hash").isEmpty():
        raise_on_failure(unique_report(df, *key), table)


def key_report(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """table_name, check_name, failing_rows: surplus rows of the key of each table."""
    found = None
    for name, (df, key) in tables.items():
        one = unique_report(df, key).select(F.lit(name).alias("table_name"), "*")
        found = one if found is None else found.unionByName(one)
    return found


def fanout_report(before: DataFrame, after: DataFrame, suppliers: DataFrame) -> DataFrame:
    """What the supplier lookup does to the waste rows: their number before and after it, and the
    items that have several current suppliers, whose waste counts once for each."""
    rows_before = before.agg(F.count(F.lit(1)).alias("rows_before"))
    rows_after = after.agg(F.count(F.lit(1)).alias("rows_after"))
    shared = duplicate_keys(suppliers, "menu_item_id").agg(F.count(F.lit(1)).alias("shared_items"))
    return rows_before.select("rows_before", rows_after.scalar().alias("rows_after"), shared.scalar().alias("shared_items"))


# --- Silver and facts -----------------------------------------------------------------


def silver_checks() -> list[Check]:
    # The names of the checks, and the message in raise_on_failure.
    col = F.col
    reason = col("waste_reason")
    return [
        ("waste_lte_prepared", col("quantity_wasted") <= col("quantity_prepared")),
        ("waste_pct_0_to_100", col("waste_percentage").between(0, 100)),
        ("location_id_not_null", col("location_id").isNotNull()),
        ("menu_item_id_not_null", col("menu_item_id").isNotNull()),
        ("date_not_null", col("date").isNotNull()),
        ("valid_waste_reason", reason.isin(*WASTE_REASONS) | reason.isNull()),
        ("waste_cost_gte_0", col("waste_cost") >= 0),
        ("quantity_consumed_gte_0", col("quantity_consumed") >= 0),
        ("quantity_prepared_gt_0", col("quantity_prepared") > 0),
        ("waste_pct_not_null", col("waste_percentage").isNotNull()),
    ]


def range_checks() -> list[Check]:
    """Every measure of Silver is finite and small enough to be summed exactly."""
    measures = [f.name for f in SILVER.fields if f.dataType.typeName() == "double"]
    return [(f"{c}_in_range", in_range(c)) for c in measures]


def _present(*columns: str) -> list[Check]:
    return [(f"{c}_not_null", F.col(c).isNotNull()) for c in columns]


def fact_checks(fact: str) -> list[Check]:
    keys = ("date_sk", "location_sk", "menu_sk", "meal_period_sk")
    return {
        "fact_production": _present(*keys),
        "fact_waste": [*_present(*keys), ("waste_cost_gte_0", F.col("waste_cost") >= 0)],
        "fact_consumption": [
            ("consumed_gte_0", F.col("quantity_consumed") >= 0),
            *_present("date_sk"),
        ],
        "fact_waste_summary": [
            ("totals_gt_0", F.col("total_waste_quantity") > 0),
            *_present("location_sk"),
        ],
    }[fact]


# --- Version history ------------------------------------------------------------------


def overlapping_versions(
    dim: DataFrame,
    entity: str = "supplier_id",
    start: str = "effective_date",
    end: str = "expiry_date",
) -> DataFrame:
    """Versions that start on or before the day the entity's previous version ends.

    The previous version is looked up within the year of the start date; the first version
    of each year is compared with the last one of the entity's previous year in use. So an
    entity with very many versions is spread over its years instead of one task.
    """
    order = [F.col(start), F.col(end), F.col("supplier_sk")]
    dated = dim.select(
        entity, "supplier_sk", F.col(start).cast("date"), F.col(end).cast("date")
    ).withColumn("_span", F.year(start))

    within = Window.partitionBy(entity, "_span").orderBy(*order)
    ranked = dated.withColumns(
        {"_previous_end": F.lag(end).over(within), "_rank": F.row_number().over(within)}
    )
    last_of_span = dated.groupBy(entity, "_span").agg(
        F.max_by(end, F.struct(*order)).alias("_last_end")
    )
    spans = Window.partitionBy(entity).orderBy("_span")
    handover = last_of_span.select(
        entity, "_span", F.lag("_last_end").over(spans).alias("_handover_end")
    )
    inside = ranked.where("_rank > 1")
    firsts = (
        ranked.where("_rank = 1")
        .join(handover, [entity, "_span"])
        .withColumn("_previous_end", F.col("_handover_end"))
        .drop("_handover_end")
    )
    return (
        inside.unionByName(firsts)
        .where(F.col("_previous_end") >= F.col(start))
        .select(entity, "supplier_sk", F.col("_previous_end").alias("previous_end"), start)
    )


def version_report(dim: DataFrame) -> DataFrame:
    """The three rules of a versioned supplier table, one row each."""
    several_current = (
        dim.where("is_current")
        .groupBy("supplier_id")
        .agg(F.count(F.lit(1)).alias("current_rows"))
        .where("current_rows > 1")
    )

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("failing_rows")).select(
            F.lit(name).alias("check_name"), "failing_rows"
        )

    surplus = duplicate_keys(dim, "supplier_sk").agg(
        F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("failing_rows")
    ).select(F.lit("unique_supplier_sk").alias("check_name"), "failing_rows")
    return (
        counted(several_current, "one_current_per_supplier")
        .unionByName(surplus)
        .unionByName(counted(overlapping_versions(dim), "no_overlapping_versions"))
    )


def gate_versions(dim: DataFrame, table: str = "dim_supplier") -> None:
    raise_on_failure(version_report(dim), table)
