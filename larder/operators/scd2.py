"""Supplier history: every tracked change closes the current version and opens a new one."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.text import strip, surrogate_key, to_any_day, to_double, to_int
from larder.operators.clean import keep_first, strip_text
from larder.schemas import DIMS, LOAD_DATE, OPEN_END, SUPPLIER_COLUMNS, SUPPLIER_TRACKED

COLUMNS = DIMS["dim_supplier"].names

# The flag texts that mean "current".
TRUE_TEXTS = ("1", "True", "true", "1.0")


def latest_suppliers(records: DataFrame, by_load: bool = False) -> DataFrame:
    """The latest current record per supplier out of any number of load snapshots; with
    ``by_load`` that of each supplier in each snapshot, with its load date.

    If no record at all (of the snapshot) is flagged current, every record counts. Columns a feed
    may lack (is_current, effective_from) are optional, as are trailing tie-breaks.
    """
    load = [LOAD_DATE] if by_load else []
    stripped = strip_text(records).where("supplier_id is not null")
    typed = stripped.withColumns(
        {"lead_time_days": to_int("lead_time_days"), "quality_score": to_double("quality_score")}
    )
    if "is_current" in typed.columns:
        flagged = typed.withColumn(
            "_current", F.coalesce(F.col("is_current").isin(*TRUE_TEXTS), F.lit(False))
        )
        if by_load:
            current = flagged.groupBy(LOAD_DATE).agg(F.max("_current").alias("_any"))
            flagged = flagged.join(current, LOAD_DATE)
        else:
            any_current = flagged.agg(F.coalesce(F.max("_current"), F.lit(False))).scalar()
            flagged = flagged.withColumn("_any", any_current)
        typed = flagged.where(F.col("_current") | ~F.col("_any"))
    order = []
    if "effective_from" in typed.columns:
        order.append(to_any_day("effective_from").desc_nulls_last())
    for column in ("ingestion_timestamp", "supplier_record_id"):
        if column in typed.columns:
            order.append(F.col(column).desc_nulls_last())
    order += [F.col(c).asc_nulls_last() for c in SUPPLIER_COLUMNS if c in typed.columns]
    kept = [c for c in SUPPLIER_COLUMNS if c in typed.columns]
    return keep_first(typed, [*load, "supplier_id"], order).select(*load, *kept)


def history(snapshots: DataFrame, tracked: Sequence[str] = SUPPLIER_TRACKED) -> DataFrame:
    """The versions of all suppliers from all their snapshots (``load_date`` and the supplier's
    columns), whatever the order in which these arrived.

    A version begins with a supplier's first snapshot, and with each whose tracked columns differ
    from the snapshot before; it ends the day before the next begins. Other columns are those of
    the snapshot it begins with. A supplier that a snapshot leaves out keeps its version. Merging
    the snapshots one by one with ``apply_scd2``, in the order of their dates, gives the same rows.
    A supplier has one row a snapshot, so the window over its rows stays small.
    """
    ordered = Window.partitionBy("supplier_id").orderBy(LOAD_DATE)
    previous = F.lag(F.struct(*tracked)).over(ordered)
    cleaned = snapshots.withColumn("supplier_name", strip("supplier_name"))
    begins = (
        cleaned.withColumn("_same", F.struct(*tracked).eqNullSafe(previous))
        .where(~F.col("_same"))
        .withColumn("_next", F.lead(LOAD_DATE).over(ordered))
    )
    day = F.date_format(LOAD_DATE, "yyyy-MM-dd")
    closed = F.date_format(F.date_sub("_next", 1), "yyyy-MM-dd")
    values = {
        "supplier_sk": surrogate_key("supplier_id", day),
        "effective_date": day,
        "expiry_date": F.coalesce(closed, F.lit(OPEN_END)),
        "is_current": F.col("_next").isNull(),
    }
    kinds = {f.name: f.dataType for f in DIMS["dim_supplier"].fields}
    return begins.select(*(values.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in COLUMNS))


def _one_row_per_supplier(incoming: DataFrame) -> DataFrame:
    for name in SUPPLIER_COLUMNS:
        if name not in incoming.columns:
            incoming = incoming.withColumn(name, F.lit(None))
    kinds = {f.name: f.dataType for f in DIMS["dim_supplier"].fields}
    typed = incoming.select([F.col(c).cast(kinds[c]).alias(c) for c in SUPPLIER_COLUMNS])
    typed = typed.withColumn("supplier_name", strip("supplier_name"))
    rest = [F.col(c).asc_nulls_last() for c in SUPPLIER_COLUMNS[1:]]
    return keep_first(typed.where("supplier_id is not null"), ["supplier_id"], rest)


def apply_scd2(
    existing: DataFrame | None,
    incoming: DataFrame,
    run_date: date,
    tracked: Sequence[str] = SUPPLIER_TRACKED,
    overwrite: Sequence[str] = (),
) -> DataFrame:
    """Merge one snapshot of suppliers into their history.

    New supplier: a version open from ``run_date``. Changed in a tracked column: the current
    version ends the day before and a new one opens; a version that itself opened on (or
    after) ``run_date`` is replaced in place, so a second run on one day cannot end before
    it starts. Unchanged or absent: kept. Columns in ``overwrite`` are refreshed on the
    current version without a new one. One join on current versions; closed ones pass by.
    """
    today = run_date.isoformat()
    fresh = _one_row_per_supplier(incoming)

    def opened(source: str = "") -> Column:
        values = {c: F.col(f"{source}{c}") for c in SUPPLIER_COLUMNS}
        values["supplier_sk"] = surrogate_key(values["supplier_id"], F.lit(today))
        values["effective_date"] = F.lit(today)
        values["expiry_date"] = F.lit(OPEN_END)
        values["is_current"] = F.lit(True)
        return F.struct(*[values[c].alias(c) for c in COLUMNS])

    if existing is None:
        return fresh.select(opened().alias("v")).select("v.*")

    is_current = F.coalesce("is_current", F.lit(False))
    closed_before = existing.where(~is_current).select(*COLUMNS)
    current = existing.where(is_current).select(F.struct(*COLUMNS).alias("cur"))
    arriving = fresh.select(F.struct(*SUPPLIER_COLUMNS).alias("inc"))
    pairs = current.join(arriving, F.col("cur.supplier_id") == F.col("inc.supplier_id"), "full")

    def kept(**changes: Column) -> Column:
        return F.struct(*[changes.get(c, F.col(f"cur.{c}")).alias(c) for c in COLUMNS])

    same = F.lit(True)
    for column in tracked:
        same = same & F.col(f"cur.{column}").eqNullSafe(F.col(f"inc.{column}"))
    ended = kept(
        expiry_date=F.date_format(F.date_sub(F.lit(run_date), 1), "yyyy-MM-dd"),
        is_current=F.lit(False),
    )
    replaced = kept(**{c: F.col(f"inc.{c}") for c in SUPPLIER_COLUMNS})
    refreshed = kept(**{c: F.col(f"inc.{c}") for c in overwrite})

    versions = (
        F.when(F.col("cur").isNull(), F.array(opened("inc.")))
        .when(F.col("inc").isNull(), F.array(kept()))
        .when(same, F.array(refreshed))
        .when(F.col("cur.effective_date") >= today, F.array(replaced))
        .otherwise(F.array(ended, opened("inc.")))
    )
    merged = pairs.select(F.inline(versions)).select(*COLUMNS)
    return closed_before.unionByName(merged)


def supplier_as_of(rows: DataFrame, dim: DataFrame, on: str = "menu_item_id", day: str = "date") -> DataFrame:
    """Rows with the supplier versions of their item that were valid on their date.

    The join is on item and year: a version is repeated for each year it was valid in, up to the
    last year of the rows, so a row meets the versions of its own year only.
    """
    span = rows.agg(F.min(F.year(day)).alias("lo"), F.max(F.year(day)).alias("hi"))
    versions = dim.select(
        on, "supplier_sk", "supplier_id", "quality_score",
        F.col("effective_date").cast("date").alias("_from"),
        F.col("expiry_date").cast("date").alias("_to"),
    )
    first = F.greatest(F.year("_from"), span.select("lo").scalar())
    last = F.least(F.year("_to"), span.select("hi").scalar())
    spread = versions.withColumns({"_first": first, "_last": last}).where("_first <= _last").withColumn(
        "_year", F.explode(F.sequence("_first", "_last"))
    )
    dated = rows.withColumn("_row_year", F.year(day))
    matches = (
        (dated[on] == spread[on]) & (dated["_row_year"] == spread["_year"])
        & dated[day].between(spread["_from"], spread["_to"])
    )
    return dated.join(spread, matches, "left").drop(spread[on]).drop(
        "_from", "_to", "_first", "_last", "_year", "_row_year"
    )
