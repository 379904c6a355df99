"""The standard analytical questions over the star schema.

Each takes the gold tables by name and a period. Results carry full precision
(``functions.round_for_display`` rounds them) and no order; sort at the display edge.
Facts are filtered on their partition columns and summed by surrogate key before any
dimension is joined.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.measures import (
    AMOUNT, PERCENT, exact_mean, percent_of, total_of_totals,
)

Gold = Mapping[str, DataFrame]
Stage = Callable[[DataFrame], DataFrame]


def in_period(df: DataFrame, year: int, month_lo: int = 1, month_hi: int = 12) -> DataFrame:
    return df.where((F.col("year") == year) & F.col("month").between(month_lo, month_hi))


def with_previous(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """The value of the row before, and the change from it in percent."""
    window = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    previous = F.col("prev_month_cost")
    return df.withColumn("prev_month_cost", F.lag(value).over(window)).withColumn(
        "mom_pct_change", percent_of(F.col(value) - previous, previous)
    )


# --- Monthly cost by location ----------------------------------------------------------


def mom_by_location(gold: Gold, year: int, month_lo: int = 1, month_hi: int = 12) -> DataFrame:
    """Monthly waste cost per location, the month before and the change in percent."""
    monthly = (
        in_period(gold["fact_waste_summary"], year, month_lo, month_hi)
        .groupBy("location_sk", "year", "month")
        .agg(total_of_totals("total_waste_cost").alias("total_waste_cost"))
    )
    return _named_change(gold, monthly, ["year", "month"])


def mom_by_location_literal(gold: Gold, year: int, month_lo: int = 1, month_hi: int = 12) -> DataFrame:
    """The same over summary rows as they are: the row before may be another category of
    the same month. Category settles the order within a month."""
    rows = in_period(gold["fact_waste_summary"], year, month_lo, month_hi)
    return _named_change(gold, rows, ["year", "month", "category"])


def _named_change(gold: Gold, rows: DataFrame, order: list[str]) -> DataFrame:
    changed = with_previous(rows, ["location_sk"], order, "total_waste_cost")
    names = gold["dim_location"].select("location_sk", "location_name")
    return changed.join(names, "location_sk").select(
        "location_name", "year", "month", "total_waste_cost", "prev_month_cost", "mom_pct_change"
    )


# --- Menu items ------------------------------------------------------------------------


def item_totals(gold: Gold, year: int, month_lo: int = 1, month_hi: int = 12) -> DataFrame:
    """Waste per (item name, category), as decimals: ``cost``, ``quantity`` and the parts of
    the mean percentage."""
    per_key = (
        in_period(gold["fact_waste"], year, month_lo, month_hi)
        .groupBy("menu_sk")
        .agg(
            F.sum(F.col("waste_cost").cast(AMOUNT)).alias("cost"),
            F.sum(F.col("quantity_wasted").cast(AMOUNT)).alias("quantity"),
            F.sum(F.col("waste_percentage").cast(PERCENT)).alias("percent"),
            F.count("waste_percentage").alias("rows"),
        )
    )
    names = gold["dim_menu"].select("menu_sk", "menu_item_name", "category")
    return (
        per_key.join(names, "menu_sk")
        .groupBy("menu_item_name", "category")
        .agg(*[F.sum(c).alias(c) for c in ("cost", "quantity", "percent", "rows")])
    )


def top_menu_items(
    gold: Gold, year: int, month_lo: int = 1, month_hi: int = 12, n: int = 10, stage: Stage = lambda df: df
) -> DataFrame:
    """Items with the n highest waste costs; equal costs share a rank, without gaps.

    The n highest distinct costs come from a distributed top-n; only those n rows are
    numbered, and items are matched to them. ``stage`` may store the items, which are read twice.
    """
    items = stage(item_totals(gold, year, month_lo, month_hi))
    highest = items.select("cost").distinct().orderBy(F.desc("cost")).limit(n)
    ranks = highest.withColumn("waste_rank", F.row_number().over(Window.orderBy(F.desc("cost"))))
    return items.join(F.broadcast(ranks), "cost").select(
        "menu_item_name", "category", F.col("cost").cast("double").alias("total_waste_cost"),
        "waste_rank",
    )


# --- Demand against supply -------------------------------------------------------------

_EVENT = ("date_sk", "location_sk", "menu_sk")


def demand_gap(gold: Gold, year: int, month_lo: int = 1, month_hi: int = 12) -> DataFrame:
    """Prepared, consumed and demand gap per category with its waste.

    Both facts are summed to (day, location, item) before they meet, so items with several
    meals on a day are counted once.
    """
    supply = _supply_and_demand(gold, year, month_lo, month_hi, every_pair=False)
    return _gap_by_category(gold, supply, year, month_lo, month_hi)


def demand_gap_literal(gold: Gold, year: int, month_lo: int = 1, month_hi: int = 12) -> DataFrame:
    """The same with every production row of a (day, location, item) matched with every
    consumption row of it, as a plain row join does. The sums over those pairs are the sums
    of one side times the row count of the other, so no pair is ever built."""
    supply = _supply_and_demand(gold, year, month_lo, month_hi, every_pair=True)
    return _gap_by_category(gold, supply, year, month_lo, month_hi)


def _supply_and_demand(
    gold: Gold, year: int, month_lo: int, month_hi: int, every_pair: bool
) -> DataFrame:
    def amount(column: str) -> Column:
        return F.sum(F.col(column).cast(AMOUNT)).alias(column)

    made = (
        in_period(gold["fact_production"], year, month_lo, month_hi)
        .groupBy(*_EVENT)
        .agg(amount("quantity_prepared"), F.count("production_sk").alias("made_rows"))
    )
    used = (
        in_period(gold["fact_consumption"], year, month_lo, month_hi)
        .groupBy(*_EVENT)
        .agg(
            amount("quantity_consumed"), amount("demand_gap"),
            F.count("consumption_sk").alias("used_rows"),
        )
    )
    one = F.lit(1).cast("decimal(10,0)")
    per_made = F.col("used_rows").cast("decimal(10,0)") if every_pair else one
    per_used = F.col("made_rows").cast("decimal(10,0)") if every_pair else one
    return (
        made.join(used, list(_EVENT))
        .groupBy("menu_sk")
        .agg(
            F.sum(F.col("quantity_prepared") * per_made).alias("prepared"),
            F.sum(F.col("quantity_consumed") * per_used).alias("consumed"),
            F.sum(F.col("demand_gap") * per_used).alias("gap"),
        )
    )


def _gap_by_category(
    gold: Gold, supply: DataFrame, year: int, month_lo: int, month_hi: int
) -> DataFrame:
    categories = gold["dim_menu"].select("menu_sk", "category")
    by_category = (
        supply.join(categories, "menu_sk")
        .groupBy("category")
        .agg(
            *[
                F.sum(F.col(source).cast("decimal(34,4)")).cast("double").alias(name)
                for source, name in (
                    ("prepared", "total_prepared"), ("consumed", "total_consumed"),
                    ("gap", "total_demand_gap"),
                )
            ]
        )
    )
    waste = (
        in_period(gold["fact_waste_summary"], year, month_lo, month_hi)
        .groupBy("category")
        .agg(
            total_of_totals("total_waste_cost").alias("total_waste_cost"),
            exact_mean("avg_waste_percentage").alias("avg_waste_pct"),
        )
    )
    return by_category.join(waste, "category").select(
        "category", "total_prepared", "total_consumed", "total_demand_gap", "total_waste_cost",
        "avg_waste_pct",
        percent_of(F.col("total_demand_gap"), F.col("total_prepared")).alias("gap_pct"),
    )


# --- Suppliers -------------------------------------------------------------------------


def supplier_quality_vs_waste(
    gold: Gold, year: int, month_lo: int = 1, month_hi: int = 12, stage: Stage = lambda df: df
) -> DataFrame:
    """Every waste row of a current supplier beside the supplier's mean and the overall mean.

    Means come from a grouped sum, not from a window over the rows, so a supplier behind
    most rows is not gathered in one task. ``stage`` may store the rows of the period, which are read
    twice, and the supplier side: Spark then knows its size when it plans the join with them.
    """
    rows = stage(
        in_period(gold["fact_waste"], year, month_lo, month_hi).select("supplier_sk", "menu_sk", "waste_percentage")
    )
    items = gold["dim_menu"].select("menu_sk", "menu_item_name", "category")
    current = gold["dim_supplier"].where("is_current").select(
        "supplier_sk", "supplier_name", "supplier_city", "quality_score"
    )
    sums = (
        rows.join(items.select("menu_sk"), "menu_sk", "left_semi")
        .groupBy("supplier_sk")
        .agg(
            F.sum(F.col("waste_percentage").cast(PERCENT)).alias("percent"),
            F.count("waste_percentage").alias("rows"),
        )
    )
    suppliers = stage(current.join(sums, "supplier_sk"))
    overall = suppliers.agg(F.sum("percent").cast("double") / F.sum("rows")).scalar()
    return (
        rows.join(suppliers, "supplier_sk")
        .join(items, "menu_sk")
        .select(
            "supplier_name", "supplier_city", "quality_score", "menu_item_name", "category",
            "waste_percentage",
            (F.col("percent").cast("double") / F.col("rows")).alias("supplier_avg_waste_pct"),
            overall.alias("overall_avg_waste_pct"),
        )
    )


# --- Reasons and meals -----------------------------------------------------------------


def reason_by_meal(gold: Gold, year: int, month_lo: int = 1, month_hi: int = 12) -> DataFrame:
    """Events and cost per month, meal and reason, with the share of the month's cost."""
    sums = _reason_sums(gold, year, month_lo, month_hi, "meal_period_sk")
    named = sums.join(gold["dim_meal_period"], "meal_period_sk")
    return _share_of_month(named)


def reason_by_meal_literal(gold: Gold, year: int, month_lo: int = 1, month_hi: int = 12) -> DataFrame:
    """The same with each event counted under every meal period of the dimension."""
    sums = _reason_sums(gold, year, month_lo, month_hi)
    meals = gold["dim_meal_period"].agg(F.collect_set("meal_period_name")).scalar()
    return _share_of_month(sums.withColumn("meal_period_name", F.explode(meals)))


def _reason_sums(gold: Gold, year: int, month_lo: int, month_hi: int, *by: str) -> DataFrame:
    sums = (
        in_period(gold["fact_waste"], year, month_lo, month_hi)
        .groupBy("waste_reason_sk", *by, "year", "month")
        .agg(
            F.count("waste_sk").alias("event_count"),
            F.sum(F.col("waste_cost").cast(AMOUNT)).alias("cost"),
        )
    )
    return sums.join(gold["dim_waste_reason"], "waste_reason_sk")


def _share_of_month(rows: DataFrame) -> DataFrame:
    month = F.sum("cost").over(Window.partitionBy("year", "month")).cast("double")
    cost = F.col("cost").cast("double")
    return rows.select(
        "meal_period_name", "waste_reason_name", "year", "month", "event_count",
        cost.alias("total_cost"), percent_of(cost, month).alias("pct_of_monthly_total"),
    )


# --- Root causes -----------------------------------------------------------------------

# Causes, their recommendations and the perishable categories.
OVERPRODUCTION = "Overproduction"
SPOILAGE = "Storage / Spoilage"
PORTION = "Portion Mismatch"
LOW_DEMAND = "Low Demand"
RECOMMENDATIONS = {
    OVERPRODUCTION: "You are cooking way more than guests are eating. Cut prep volume by 25% for the next 2 weeks and track whether plates run out — if they don't, lock in the lower batch size permanently.",
    SPOILAGE: "This is a fridge or timing problem, not a demand problem. Check how long items sit before service and when the supplier delivers — if it's arriving less than 12 hours before a meal, push for an earlier drop.",
    PORTION: "Portions are too generous for what guests actually want. Try a smaller default serving and let guests ask for more — most won't, and waste will drop fast.",
    LOW_DEMAND: "Guests are consistently skipping this item. Either pull it from the menu on low-traffic days or swap it out for something in the same category that actually moves.",
}
PERISHABLE = ("SALADS", "DAIRY", "FRESH JUICE", "FRUITS")


def labelled(labels: Mapping[str, str], cause: Column) -> Column:
    """The text that belongs to a cause, null for an unknown one."""
    entries = [F.lit(text) for pair in labels.items() for text in pair]
    return F.try_element_at(F.create_map(*entries), cause)


def root_cause(
    gold: Gold, year: int, month_lo: int = 1, month_hi: int = 12, *,
    very_high: float = 40, high: float = 30, elevated: float = 20, bulk: float = 5,
) -> DataFrame:
    """One cause and recommendation per location, category and month; the first rule that
    applies wins."""
    percent = F.col("avg_waste_percentage")
    per_event = F.col("total_waste_quantity") / F.nullif(F.col("waste_event_count"), F.lit(0))
    cause = (
        F.when((percent > very_high) & (per_event > bulk), OVERPRODUCTION)
        .when(F.upper("category").isin(*PERISHABLE) & (percent > elevated), SPOILAGE)
        .when((percent > high) & (per_event <= bulk), PORTION)
        .otherwise(LOW_DEMAND)
    )
    places = gold["dim_location"].select("location_sk", "location_name", "city", "region")
    rows = in_period(gold["fact_waste_summary"], year, month_lo, month_hi)
    return (
        rows.join(places, "location_sk")
        .withColumn("root_cause", cause)
        .select(
            "location_name", "city", "region", F.col("category").alias("category_name"), "year",
            "month", percent.alias("waste_percentage"), "total_waste_cost",
            "total_waste_quantity", "waste_event_count", "root_cause",
            labelled(RECOMMENDATIONS, F.col("root_cause")).alias("recommendation"),
        )
    )


def create_root_cause_view(gold: Gold, year: int, name: str = "waste_root_cause", **options) -> None:
    root_cause(gold, year, **options).createOrReplaceTempView(name)
