"""The batch run: raw feeds to Bronze, Silver and Gold on storage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import clean, dims, facts, quality, scd2, silver
from larder.schemas import DIMS, FACTS, GRAIN, LOAD_DATE, PARTITIONS, SILVER, SOURCES
from larder.sources import bronze, files, versions
from larder.sources.catalog import gold_path
from larder.sources.tables import (
    publish, read_if_present, read_or_empty, read_published, read_table, sent_if_small, write_partitions,
)


@dataclass(frozen=True)
class Paths:
    """Where the layers live. ``raw`` holds the CSV feeds."""

    raw: str
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"


class Scratch:
    """Intermediate tables of one run, in the shared folder.

    A stored intermediate cuts the lineage for good: a lost executor costs the reading
    tasks only. It also tells Spark its size, which decides how it is joined.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{files.shared_folder(spark)}/{files.new_name('larder')}"

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{files.new_name('part')}"
        df.write.option("compression", "zstd").parquet(path)
        return read_table(self.spark, path, df.schema)

    def by_month(self, df: DataFrame, rebalance: bool) -> Callable[[Iterable[str]], DataFrame]:
        """Stores rows by month; returns what reads those of some month folders."""
        path = f"{self.folder}/{files.new_name('part')}"
        write_partitions(df, path, PARTITIONS, rebalance)

        def read(months: Iterable[str]) -> DataFrame:
            folders = [f"{path}/{month}" for month in months]
            if not folders:
                return self.spark.createDataFrame([], df.schema)
            found = self.spark.read.schema(df.schema).option("basePath", path).parquet(*folders)
            return found.select(*df.columns)

        return read

    def drop(self) -> None:
        files.delete(self.spark, self.folder)


def run_bronze(
    spark: SparkSession, paths: Paths, run_date: date, batch_id: str | None = None,
    ingested_at: str | None = None, multiline: bool = False, sources: Iterable[str] = tuple(SOURCES),
) -> None:
    """Land the feeds of a day, all or some."""
    batch_id = batch_id or str(uuid.uuid4())
    ingested_at = ingested_at or datetime.now(timezone.utc).isoformat()
    for source in sources:
        raw = bronze.read_feed(spark, paths.raw, source, multiline)
        bronze.land(spark, raw, source, paths.bronze, run_date, batch_id, ingested_at)


def _sides(read, stage, waste_grain, columns: Iterable[str]) -> list[DataFrame | None]:
    """The sides of production that give one of ``columns``: no side changes its rows."""
    wanted = set(columns)

    def side(names: Iterable[str], build) -> DataFrame | None:
        return None if wanted.isdisjoint(names) else build()

    def lookup(df: DataFrame) -> DataFrame:
        return sent_if_small(stage(df))

    return [
        side(silver.OF_WASTE, waste_grain),
        side(silver.OF_MENU, lambda: lookup(silver.menu_lookup(clean.clean_menu(read("menu_data"))))),
        side(silver.OF_LOCATION, lambda: lookup(silver.location_lookup(clean.clean_location(read("location_data"))))),
    ]


def silver_from_bronze(
    read, stage, columns: Iterable[str] = SILVER.names, year: int | None = None
) -> DataFrame:
    """``read(source)`` gives a Bronze feed; ``stage`` stores an intermediate. Of the sides only
    those are joined that give one of ``columns``. With ``year``, the rows of that year."""

    def of_year(logs: DataFrame) -> DataFrame:
        return logs if year is None else logs.where(F.year("date") == year)

    production = of_year(clean.clean_production(read("production_logs")))
    waste = lambda: silver.waste_to_grain(of_year(clean.clean_waste(read("waste_logs"))))
    sides = _sides(read, stage, waste, columns)
    return silver.build_silver(production, *sides).select(*columns)


def silver_of_months(
    read, months: DataFrame, stage, columns: Iterable[str] = SILVER.names, buckets: int | None = None
) -> DataFrame:
    """Silver of the months (``year``, ``month``) from all load dates of the logs.

    A production key has the record of the last load that holds one; its waste is that of the
    last load with any for the key, if not earlier. So a month may arrive in several loads, and
    a later load corrects what it holds. Only the sides that give one of ``columns`` are joined.
    With ``buckets``, so many to a month, both logs are dealt by month and bucket (see ``dealt_once``):
    keys meet, and the result can be written as it lies.
    """
    dealt = silver.DEALT_BY if buckets else ()
    wanted = F.broadcast(months)  # as many rows as months

    def of_months(source: str, cleaned) -> DataFrame:
        dated = silver.with_buckets(cleaned(read(source)), buckets or 1)
        within = (F.col("_y") == wanted["year"]) & (F.col("_m") == wanted["month"])
        return dated.join(wanted, within, "left_semi").drop(*(() if dealt else silver.DEALT_BY))

    production = silver.latest_loads(of_months("production_logs", clean.clean_production), dealt)
    waste = lambda: silver.waste_to_grain(of_months("waste_logs", clean.clean_waste), True, dealt)
    return silver.build_silver(production, *_sides(read, stage, waste, columns)).select(*columns)


@contextmanager
def dealt_once(spark: SparkSession) -> Iterator[None]:
    """A join of rows dealt by some of its keys deals them no second time."""
    option = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(option)
    spark.conf.set(option, "false")
    try:
        yield
    finally:
        spark.conf.set(option, before)


LOGS = ("production_logs", "waste_logs")


def _of_load(spark: SparkSession, paths: Paths, source: str, run_date: date) -> DataFrame:
    return bronze.read_bronze(spark, paths.bronze, source, run_date)


def touched_months(spark: SparkSession, paths: Paths, run_date: date) -> list[str]:
    """The months ("2025-01") for which a load brought logs, as written down when it landed."""
    return sorted({m for source in LOGS for m in bronze.months_of_load(spark, paths.bronze, source, run_date)})


def run_silver(spark: SparkSession, paths: Paths, run_date: date) -> list[str]:
    """The months that one load date of Bronze touches, to Silver; returns them.

    Of the logs only the loads that hold one of these months are read. Texts that are no dates or
    numbers stop it, as do keys that occur twice in a load.
    """
    for source in (*LOGS, "menu_data"):
        quality.raise_on_failure(clean.unreadable_report(_of_load(spark, paths, source, run_date), source), source)
    months = touched_months(spark, paths, run_date)

    def read(source: str) -> DataFrame:
        if source in LOGS:
            return bronze.read_bronze(spark, paths.bronze, source, months=months)
        return _of_load(spark, paths, source, run_date).drop(LOAD_DATE)

    def gate(written: DataFrame) -> None:
        quality.gate_unique(written, *GRAIN, table="silver")

    scratch = Scratch(spark)
    try:
        wanted = spark.createDataFrame([tuple(map(int, m.split("-"))) for m in months], "year int, month int")
        # Two buckets a task, over all months, so that tasks are even.
        buckets = -(-2 * int(spark.conf.get("spark.sql.shuffle.partitions")) // max(len(months), 1))
        built = silver_of_months(read, wanted, scratch, buckets=buckets)
        with dealt_once(spark):
            publish(
                spark, built.select(*SILVER.names), paths.silver, gate, PARTITIONS,
                counts=quality.failures(quality.range_checks() + quality.silver_checks()), name="silver",
            )
    finally:
        scratch.drop()
    return months


def read_silver(spark: SparkSession, paths: Paths) -> DataFrame:
    return read_published(spark, paths.silver, SILVER)


def read_dim(spark: SparkSession, paths: Paths, name: str) -> DataFrame:
    return read_or_empty(spark, gold_path(paths.gold, name), DIMS[name])


def read_gold(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    tables = {name: read_dim(spark, paths, name) for name in DIMS}
    for name, schema in FACTS.items():
        tables[name] = read_published(spark, gold_path(paths.gold, name), schema)
    return tables


def _publish_dim(spark: SparkSession, paths: Paths, name: str, df: DataFrame, gate=None) -> None:
    sk = DIMS[name].names[0]
    gate = gate or (lambda written: quality.gate_unique(written, sk, table=name))
    publish(spark, df.select(*DIMS[name].names), gold_path(paths.gold, name), gate, unless_same=True)


def run_dims(
    spark: SparkSession, paths: Paths, calendar: tuple[date, date] | None = None
) -> None:
    """All dimensions but the supplier. The calendar covers the whole years of Silver
    unless a first and last day are given."""
    source = read_silver(spark, paths)

    def existing(name: str) -> DataFrame | None:
        return read_if_present(spark, gold_path(paths.gold, name), DIMS[name])

    days = dims.dim_date(spark, *calendar) if calendar else dims.dim_date_covering(source)
    built = {
        "dim_date": days,
        "dim_category": dims.dim_category(source),
        "dim_meal_period": dims.dim_meal_period(spark),
        "dim_waste_reason": dims.dim_waste_reason(spark),
        "dim_location": dims.dim_location(source, existing("dim_location")),
        "dim_menu": dims.dim_menu(source, existing("dim_menu")),
    }
    for name, df in built.items():
        _publish_dim(spark, paths, name, df)


def run_supplier(
    spark: SparkSession, paths: Paths, run_date: date, incoming: DataFrame | None = None
) -> None:
    """The supplier history of all snapshots in Bronze, in whatever order they arrived; or, with
    ``incoming``, one snapshot merged into the stored history as of ``run_date``. Numbers and days
    that cannot be read stop it."""
    if incoming is None:
        landed = bronze.read_bronze(spark, paths.bronze, "supplier_data")
        arrived = landed.where(F.col(LOAD_DATE) == F.lit(run_date))
        quality.raise_on_failure(clean.unreadable_report(arrived, "supplier_data"), "supplier_data")
        merged = scd2.history(scd2.latest_suppliers(landed, by_load=True))
    else:
        existing = read_if_present(spark, gold_path(paths.gold, "dim_supplier"), DIMS["dim_supplier"])
        merged = scd2.apply_scd2(existing, incoming, run_date)
    _publish_dim(spark, paths, "dim_supplier", merged, quality.gate_versions)


def build_fact(
    name: str, source: DataFrame, tables: Mapping[str, DataFrame], pick: str, stage: Scratch
) -> DataFrame:
    if name == "fact_waste":
        return facts.fact_waste(source, tables, pick, stage)
    return {
        "fact_production": facts.fact_production,
        "fact_consumption": facts.fact_consumption,
        "fact_waste_summary": facts.fact_waste_summary,
    }[name](source, tables)


#: The surrogate key of each fact that has one.
FACT_KEYS = {"fact_production": "production_sk", "fact_waste": "waste_sk", "fact_consumption": "consumption_sk"}


def months_of_changed_suppliers(waste: DataFrame, tables: Mapping[str, DataFrame], pick: str) -> DataFrame:
    """year, month: where the suppliers of an item in ``fact_waste`` are not its current ones.

    Only two keys of the fact are read, and what is joined is their distinct pairs.
    """
    have = waste.select(*PARTITIONS, "menu_sk", "supplier_sk").distinct()
    current = facts.current_suppliers(tables["dim_supplier"], pick).join(
        tables["dim_menu"].select("menu_item_id", "menu_sk"), "menu_item_id"
    )
    want = have.select(*PARTITIONS, "menu_sk").distinct().join(
        current.select("menu_sk", "supplier_sk"), "menu_sk", "left"
    )
    both = have.select(*PARTITIONS, "menu_sk", "supplier_sk", F.lit(1).alias("_side")).unionByName(
        want.select(*PARTITIONS, "menu_sk", "supplier_sk", F.lit(2).alias("_side"))
    )
    sides = both.groupBy(*PARTITIONS, "menu_sk", "supplier_sk").agg(F.sum("_side").alias("_sides"))
    return sides.where("_sides <> 3").select(*PARTITIONS).distinct()


def stale_months(
    spark: SparkSession, paths: Paths, name: str, tables: Mapping[str, DataFrame], pick: str
) -> tuple[list[str], list[str], dict]:
    """The month folders of a fact to build again, those to drop, and the note of the new state.

    A fact's pointer notes which version of each month of Silver it was built from, and for the
    waste which suppliers. So only months whose Silver changed are built again, whoever
    changed it and wherever a run was cut short; and of the waste those of items whose current
    suppliers changed.
    """
    path = gold_path(paths.gold, name)
    source, built = versions.current(spark, paths.silver), versions.current(spark, path)
    note: dict = {"silver": dict(source.parts)}
    if name == "fact_waste":
        suppliers = versions.current(spark, gold_path(paths.gold, "dim_supplier"))
        note |= {"pick": pick, "suppliers": suppliers.parts[""] if suppliers else ""}
    if built is None or built.note.get("pick") != note.get("pick"):
        return sorted(source.parts), [], note
    known = built.note["silver"]
    stale = {p for p, version in source.parts.items() if known.get(p) != version}
    gone = {p for p in built.parts if p not in source.parts}
    if built.note.get("suppliers") != note.get("suppliers"):
        rows = read_published(spark, path, FACTS[name])
        stale |= {f"year={r.year}/month={r.month}" for r in months_of_changed_suppliers(rows, tables, pick).collect()}
    return sorted(stale & source.parts.keys()), sorted(gone), note


def run_facts(
    spark: SparkSession, paths: Paths, pick: str = "all", rebalance: bool = True, rebuild: bool = False
) -> dict[str, list[str]]:
    """The four facts; returns the month folders that were built, by fact.

    Only months that changed (``stale_months``) are read and built; the others stay as they are,
    and months without rows any more are dropped. ``rebuild`` builds all. ``rebalance`` gathers
    rows by month before they are written, where a dimension is too large to be broadcast and for the
    summary; the others keep Silver's file layout anyway, and nothing of them is shuffled. Where the menu is
    too large, the rows get its keys once, stored by month, and the facts keep the layout of these.
    """
    if versions.current(spark, paths.silver) is None:
        raise FileNotFoundError(f"no table at {paths.silver}")
    tables = {name: read_dim(spark, paths, name) for name in DIMS}
    lookups = {name: sent_if_small(df) for name, df in tables.items()}
    many_items = lookups["dim_menu"] is tables["dim_menu"]
    scattered = any(lookups[name] is df for name, df in tables.items() if name != "dim_menu")

    def gate(name: str):
        return lambda written: quality.gate_unique(written, FACT_KEYS[name], table=name)

    done: dict[str, list[str]] = {}
    scratch = Scratch(spark)

    def rows(months: Iterable[str]) -> DataFrame:
        return read_published(spark, paths.silver, SILVER, months)

    try:
        changes = {name: stale_months(spark, paths, name, tables, pick) for name in FACTS}
        for name, (stale, _, note) in changes.items():
            done[name] = sorted(note["silver"]) if rebuild else stale
        keyed = rows
        of_any = sorted({month for name in FACT_KEYS for month in done[name]})
        if many_items and of_any:
            keyed = scratch.by_month(facts.with_menu_key(rows(of_any), lookups), rebalance)
        for name, (_, gone, note) in changes.items():
            stale = done[name]
            source = keyed(stale) if name in FACT_KEYS else rows(stale)
            publish(
                spark, build_fact(name, source, lookups, pick, scratch), gold_path(paths.gold, name),
                gate(name) if name in FACT_KEYS else None, PARTITIONS,
                rebalance and (scattered or name == "fact_waste_summary"), without=[*stale, *gone],
                counts=quality.failures(quality.fact_checks(name), "fail"), name=name, note=note,
            )
    finally:
        scratch.drop()
    return done


def run(
    spark: SparkSession, paths: Paths, run_date: date, *, pick: str = "all",
    calendar: tuple[date, date] | None = None,
) -> dict[str, DataFrame]:
    """All stages in order; facts resolve keys from dimensions, so those come first."""
    run_bronze(spark, paths, run_date)
    run_silver(spark, paths, run_date)
    run_dims(spark, paths, calendar)
    run_supplier(spark, paths, run_date)
    run_facts(spark, paths, pick)
    return read_gold(spark, paths)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    combined = counts[0]
    for df in counts[1:]:
        combined = combined.unionByName(df)
    return combined
