"""The tables behind the report pages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.measures import AMOUNT, exact_mean, exact_sum, percent_of, total_of_totals
from larder.plans.marts import Gold, item_totals, labelled, root_cause, with_previous

ALL = "All"

# The short recommendation shown for each cause.
SHORT_RECOMMENDATIONS = {
    "Overproduction": "Cut prep volume by 25% — you're cooking more than guests eat.",
    "Storage / Spoilage": "Fix fridge timing or push supplier to deliver closer to service.",
    "Portion Mismatch": "Shrink the default portion — most guests won't ask for more.",
    "Low Demand": "Pull this item on slow days or swap it for something that moves.",
}


def _summary(gold: Gold, year: int) -> DataFrame:
    return gold["fact_waste_summary"].where(F.col("year") == year)


def _month_start():
    return F.make_date("year", "month", F.lit(1))


# --- Overview --------------------------------------------------------------------------


def available_years(gold: Gold) -> DataFrame:
    return gold["fact_waste_summary"].select("year").distinct().orderBy("year")


def filter_values(gold: Gold, year: int) -> DataFrame:
    """kind, value: what the year, category, location and cause filters offer, in order."""
    kinds = (
        ("year", available_years(gold), "year"),
        ("category", gold["dim_category"], "category_name"),
        ("location", gold["dim_location"], "location_name"),
        ("cause", root_cause(gold, year), "root_cause"),
    )
    found = None
    for kind, df, column in kinds:
        one = df.select(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("value"))
        found = one if found is None else found.unionByName(one)
    return found.where("value is not null").distinct()


def _rising(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def _falling(name: str) -> list[Column]:
    return [F.col(name).desc_nulls_last()]


#: The order in which each mart and report is shown.
DISPLAY_ORDER: dict[str, Callable[[], list[Column]]] = {
    "mom_by_location": lambda: _rising("location_name", "year", "month"),
    "top_menu_items": lambda: _rising("waste_rank"),
    "demand_gap": lambda: _falling("total_demand_gap"),
    "supplier_quality_vs_waste": lambda: _rising("quality_score") + _falling("waste_percentage"),
    "reason_by_meal": lambda: _rising("meal_period_name") + _falling("total_cost"),
    "root_cause": lambda: _falling("waste_percentage"),
    "filter_values": lambda: _rising("kind", "value"),
}


def in_display_order(df: DataFrame, name: str) -> DataFrame:
    """A mart in the order in which it is shown. The marts themselves are not sorted, as most
    uses filter or join them further. All other columns settle ties."""
    return df.orderBy(*DISPLAY_ORDER[name](), *_rising(*df.columns))


def first_shown(df: DataFrame, name: str, columns: Sequence[str], n: int = 20) -> DataFrame:
    """position, values: the n rows shown first, by the named columns as text."""
    texts = [F.col(c).cast("decimal(28,4)") if kind == "double" else F.col(c) for c, kind in df.select(*columns).dtypes]
    shown = in_display_order(df, name).limit(n).select(F.concat_ws("|", *(t.cast("string") for t in texts)).alias("v"))
    rows = shown.agg(F.collect_list("v").alias("v"))
    return rows.select(F.posexplode("v").alias("position", "shown"))


def kpi_monthly(gold: Gold, year: int) -> DataFrame:
    return (
        _summary(gold, year)
        .groupBy("year", "month")
        .agg(
            total_of_totals("total_waste_quantity").alias("total_waste_quantity"),
            total_of_totals("total_waste_cost").alias("total_waste_cost"),
            exact_mean("avg_waste_percentage").alias("avg_waste_percentage"),
        )
        .withColumn("month_label", F.date_format(_month_start(), "MMM"))
    )


def kpi_totals(gold: Gold, year: int) -> DataFrame:
    """One row for the year; the percentage is the mean of the monthly means."""
    return kpi_monthly(gold, year).agg(
        total_of_totals("total_waste_quantity").alias("total_waste_quantity"),
        total_of_totals("total_waste_cost").alias("total_waste_cost"),
        exact_mean("avg_waste_percentage").alias("avg_waste_percentage"),
    )


def waste_pct_weighted(silver: DataFrame, year: int) -> DataFrame:
    """Per month: wasted share of all that was prepared, beside the unweighted mean of the
    same rows."""
    wasted = silver.where((F.col("year") == year) & (F.col("quantity_wasted") > 0))
    sums = wasted.groupBy("year", "month").agg(
        exact_sum("quantity_wasted").alias("quantity_wasted"),
        exact_sum("quantity_prepared").alias("quantity_prepared"),
        exact_mean("waste_percentage").alias("mean_waste_pct"),
    )
    weighted = percent_of(F.col("quantity_wasted"), F.col("quantity_prepared"))
    return sums.withColumn("weighted_waste_pct", weighted)


# --- Locations -------------------------------------------------------------------------


def location_trend(gold: Gold, year: int) -> DataFrame:
    names = gold["dim_location"].select("location_sk", "location_name")
    return (
        _summary(gold, year)
        .join(names, "location_sk")
        .groupBy("location_name", "year", "month")
        .agg(
            total_of_totals("total_waste_cost").alias("total_waste_cost"),
            total_of_totals("total_waste_quantity").alias("total_waste_quantity"),
            exact_mean("avg_waste_percentage").alias("avg_waste_pct"),
        )
        .withColumn("period", _month_start())
    )


def top_locations(gold: Gold, year: int, n: int = 5) -> DataFrame:
    names = gold["dim_location"].select("location_sk", "location_name")
    return (
        _summary(gold, year)
        .join(names, "location_sk")
        .groupBy("location_name")
        .agg(total_of_totals("total_waste_cost").alias("total_waste_cost"))
        .orderBy(F.desc("total_waste_cost"), "location_name")
        .limit(n)
    )


def location_trend_topn(gold: Gold, year: int, n: int = 4) -> DataFrame:
    """The trend of the n costliest locations."""
    top = top_locations(gold, year, n).select("location_name")
    return location_trend(gold, year).join(F.broadcast(top), "location_name", "left_semi")


def costliest_location(gold: Gold, year: int) -> DataFrame:
    return top_locations(gold, year, 1)


# --- Items and categories --------------------------------------------------------------


def _as_item_report(items: DataFrame, *extra: str) -> DataFrame:
    return items.select(
        "menu_item_name", "category",
        F.col("cost").cast("double").alias("total_waste_cost"),
        F.col("quantity").cast("double").alias("total_waste_quantity"),
        (F.col("percent").cast("double") / F.col("rows")).alias("avg_waste_pct"),
        *extra,
    )


def top_items_by_category(
    gold: Gold, year: int, category: str = ALL, n: int = 10,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """The n costliest items, of one category or of all, each with its rank among all items.

    A rank is one more than the number of distinct higher costs, counted for the n rows in
    one pass; ranking all items in one place is not needed. ``stage`` may store the totals,
    which are read three times.
    """
    items = stage(item_totals(gold, year))
    wanted = items if category == ALL else items.where(F.col("category") == category)
    top = wanted.orderBy(F.desc("cost"), "menu_item_name", "category").limit(n)
    shown = top.agg(F.sort_array(F.collect_set("cost"), asc=False)).scalar()
    costs = items.select("cost").distinct().withColumn("shown", shown)
    higher = [F.count_if(F.col("cost") > F.get("shown", F.lit(i))) + 1 for i in range(n)]
    ranks = costs.agg(F.first("shown").alias("cost"), F.array(*higher).alias("waste_rank"))
    ranks = ranks.select(F.inline(F.arrays_zip("cost", "waste_rank"))).where("cost is not null")
    ranked = top.join(F.broadcast(ranks), "cost")
    return _as_item_report(ranked.withColumn("waste_rank", F.col("waste_rank").cast("int")), "waste_rank")


def top_items_by_qty(gold: Gold, year: int, n: int = 5) -> DataFrame:
    top = item_totals(gold, year).orderBy(F.desc("quantity"), "menu_item_name", "category").limit(n)
    return _as_item_report(top)


def worst_category(gold: Gold, year: int) -> DataFrame:
    return (
        _summary(gold, year)
        .groupBy("category")
        .agg(exact_mean("avg_waste_percentage").alias("avg_waste_pct"))
        .orderBy(F.desc("avg_waste_pct"), "category")
        .limit(1)
    )


def category_slice(gold: Gold, year: int, category: str) -> DataFrame:
    """Summary of one category, named in any case."""
    return (
        _summary(gold, year)
        .where(F.lower("category") == category.lower())
        .groupBy("category", "year", "month")
        .agg(
            total_of_totals("total_waste_quantity").alias("total_waste_quantity"),
            total_of_totals("total_waste_cost").alias("total_waste_cost"),
            exact_mean("avg_waste_percentage").alias("avg_waste_percentage"),
            F.sum("waste_event_count").alias("waste_event_count"),
        )
    )


# --- Trends ----------------------------------------------------------------------------


def trend_mom(gold: Gold, year: int) -> DataFrame:
    """Cost per month of the year, the month before and the change; at most twelve rows are
    ordered."""
    monthly = (
        _summary(gold, year)
        .groupBy("year", "month")
        .agg(total_of_totals("total_waste_cost").alias("total_waste_cost"))
    )
    return with_previous(monthly, ["year"], ["month"], "total_waste_cost").withColumn(
        "period", _month_start()
    )


def trend_spikes(gold: Gold, year: int, above: float = 10.0) -> DataFrame:
    """Months whose cost rose by more than ``above`` percent."""
    spikes = trend_mom(gold, year).where(F.col("mom_pct_change") > above)
    return spikes.select(
        F.date_format("period", "MMM yyyy").alias("month_label"), "total_waste_cost",
        "mom_pct_change",
    )


# --- Root causes -----------------------------------------------------------------------


def root_cause_counts(gold: Gold, year: int) -> DataFrame:
    return (
        root_cause(gold, year)
        .groupBy("root_cause")
        .agg(F.count(F.lit(1)).alias("group_count"))
        .orderBy(F.desc("group_count"), "root_cause")
    )


def root_cause_filtered(
    gold: Gold, year: int, location: str = ALL, cause: str = ALL
) -> DataFrame:
    """The root-cause table, optionally of one location or cause, with short texts."""
    rows = root_cause(gold, year)
    if location != ALL:
        rows = rows.where(F.col("location_name") == location)
    if cause != ALL:
        rows = rows.where(F.col("root_cause") == cause)
    short = labelled(SHORT_RECOMMENDATIONS, F.col("root_cause"))
    return rows.select(
        "location_name", "category_name", "year", "month", "waste_percentage",
        "total_waste_cost", "root_cause",
        F.coalesce(short, "recommendation").alias("recommendation"),
    )


# --- Fixed questions -------------------------------------------------------------------


def commonest_reason(gold: Gold, year: int) -> DataFrame:
    counts = (
        gold["fact_waste"].where(F.col("year") == year)
        .groupBy("waste_reason_sk").agg(F.count(F.lit(1)).alias("event_count"))
    )
    return (
        counts.join(gold["dim_waste_reason"], "waste_reason_sk")
        .select("waste_reason_name", "event_count")
        .orderBy(F.desc("event_count"), "waste_reason_name")
        .limit(1)
    )


def costliest_supplier(gold: Gold, year: int) -> DataFrame:
    """The current supplier with the highest waste cost on its items."""
    sums = (
        gold["fact_waste"].where((F.col("year") == year) & F.col("supplier_sk").isNotNull())
        .groupBy("supplier_sk").agg(F.sum(F.col("waste_cost").cast(AMOUNT)).alias("cost"))
    )
    current = gold["dim_supplier"].where("is_current")
    return (
        sums.join(current, "supplier_sk")
        .orderBy(F.desc("cost"), "supplier_id")
        .limit(1)
        .select(
            "supplier_id", "supplier_name", F.col("cost").cast("double").alias("total_waste_cost")
        )
    )
