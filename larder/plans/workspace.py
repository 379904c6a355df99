"""The layers built from the driver's tables, for the registered queries.

Each table is built when first asked for and stored in the shared folder; later queries of
the same session read it, as reports read a gold layer. A table is known by the session and
the data folder, so a new session starts afresh.
"""

from __future__ import annotations

import threading
from collections import ChainMap
from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import clean, dims, facts, scd2
from larder.plans.batch import Scratch, build_fact, silver_from_bronze
from larder.schemas import (
    DIMS, FACTS, GRAIN, LOAD_DATE, LOCATION_ATTRIBUTES, MENU_ATTRIBUTES, PARTITIONS, SILVER,
)
from larder.sources import bronze, files, testfeeds
from larder.sources.tables import read_table, sent_if_small, write_partitions

BATCH_ID = "batch-1998-01-01"

#: Gold tables that need so few columns of Silver that they do not have it stored for themselves.
_FEW = {
    "dim_date": ("date", "year"),
    "dim_category": ("category",),
    "dim_location": ("date", "location_id", *LOCATION_ATTRIBUTES),
    "dim_menu": ("date", "menu_item_id", *MENU_ATTRIBUTES),
    "fact_production": (*GRAIN, "quantity_prepared", "cost_per_unit", "batch_id", *PARTITIONS),
    "fact_consumption": (
        *GRAIN, "quantity_prepared", "quantity_wasted", "quantity_consumed", "demand_gap", *PARTITIONS,
    ),
    "fact_waste": (*GRAIN, "waste_reason", "quantity_wasted", "waste_percentage", "waste_cost", *PARTITIONS),
    "fact_waste_summary": ("location_id", "category", "quantity_wasted", "waste_percentage", "waste_cost", *PARTITIONS),
}

#: What any of the facts needs of Silver.
_OF_FACTS = tuple(c for c in SILVER.names if any(c in _FEW[name] for name in FACTS))

_open: dict[tuple[str, str], Workspace] = {}
_lock = threading.RLock()


class Workspace(Mapping):
    """Gold tables by name; also Bronze feeds and Silver through their own methods."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.stage = Scratch(spark)
        self._stored: dict[str, tuple[str, object]] = {}
        self._done: dict[object, object] = {}
        self._silvers: dict[str, tuple[frozenset[str], int | None]] = {}

    def _table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with _lock:
            if name not in self._stored:
                df = build()
                path = f"{self.stage.folder}/{name}"
                if name == "silver" or name in FACTS:
                    # Facts over stored Silver keep its layout; the joins and the summary do not.
                    rebalance = name in ("silver", "fact_waste_summary") or "silver" not in self._stored
                    write_partitions(df, path, PARTITIONS, rebalance)
                else:
                    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
                self._stored[name] = (path, df.schema)
            path, schema = self._stored[name]
        return read_table(self.spark, path, schema)

    def raw(self, source: str) -> DataFrame:
        """The padded text of a feed, before landing."""
        if source in testfeeds.LOGS:
            return testfeeds.LOGS[source](self.spark, self.sf_dir, self.order_keys())
        return testfeeds.MASTERS[source](self.spark, self.sf_dir)

    def order_keys(self) -> DataFrame:
        return self._table(
            "order_keys", lambda: testfeeds.order_keys(self.spark, self.sf_dir)
        )

    def _landed(self, raw: DataFrame, source: str, day=testfeeds.SECOND_LOAD) -> DataFrame:
        ready = bronze.with_metadata(
            clean.strip_text(raw), source, BATCH_ID, f"{day.isoformat()}T00:00:00+00:00"
        )
        return ready.withColumn(LOAD_DATE, F.lit(day))

    def bronze(self, source: str) -> DataFrame:
        if source == "supplier_data":
            return self._table(source, self._supplier_loads)
        return self._table(source, lambda: self._landed(self.raw(source), source))

    def _supplier_loads(self) -> DataFrame:
        first, second = (
            self._landed(testfeeds.supplier_data(self.spark, self.sf_dir, day), "supplier_data", day)
            for day in (testfeeds.FIRST_LOAD, testfeeds.SECOND_LOAD)
        )
        return first.unionByName(second)

    def silver(self) -> DataFrame:
        return self._table("silver", self.build_silver)

    def silver_with(self, columns: Iterable[str], year: int | None = None) -> DataFrame:
        """All rows of Silver, or those of one year, with some of its columns: for what reads them more than
        once. They are stored once, and gold tables that need no others are built from them."""
        columns = tuple(columns)
        with _lock:
            if (found := self._stored_silver(columns, year)) is not None:
                return found.select(*columns)
            name = files.new_name("silver")
            found = self._table(name, lambda: self.build_silver(columns, year))
            self._silvers[name] = (frozenset(columns), year)
            return found

    def _stored_silver(self, columns: Iterable[str], year: int | None = None) -> DataFrame | None:
        """Stored rows of Silver, of one year or all, that have these columns; None if there are none."""
        if "silver" in self._stored:
            found = self.silver()
            return found if year is None else found.where(F.col("year") == year)
        for name, (held, of_year) in self._silvers.items():
            if held.issuperset(columns) and (of_year == year or of_year is None and "date" in held):
                found = self._table(name, lambda: None)
                return found if of_year == year else found.where(F.year("date") == year)
        return None

    def silver_of_facts(self, year: int | None = None) -> DataFrame:
        """All rows of Silver, or those of one year, with the columns that facts need."""
        return self.silver_with(_OF_FACTS, year)

    def build_silver(self, columns: Iterable[str] = SILVER.names, year: int | None = None) -> DataFrame:
        def read(source: str) -> DataFrame:
            return self.bronze(source).drop(LOAD_DATE)

        return silver_from_bronze(read, self.stage, columns, year)

    def columns_for(self, name: str) -> tuple[str, ...]:
        """What a gold table reads of Silver."""
        return _FEW.get(name, tuple(SILVER.names))

    def silver_for(self, name: str) -> DataFrame:
        """What a gold table needs of Silver: from a stored table that has it, else, for a table that
        needs few columns, from the joins that give these."""
        if name not in _FEW:
            return self.silver()
        found = self._stored_silver(_FEW[name])
        return self.build_silver(_FEW[name]) if found is None else found

    def supplier_snapshot(self, day) -> DataFrame:
        records = self.bronze("supplier_data").where(F.col(LOAD_DATE) == F.lit(day))
        return scd2.latest_suppliers(records)

    def supplier_first_load(self) -> DataFrame:
        day = testfeeds.FIRST_LOAD
        return self._table(
            "supplier_first", lambda: scd2.apply_scd2(None, self.supplier_snapshot(day), day)
        )

    def once(self, key: object, build: Callable[[], object]) -> object:
        """What ``build()`` returns, built once under this key: feeds, landings and lakes."""
        with _lock:
            if key not in self._done:
                self._done[key] = build()
            return self._done[key]

    def build_supplier(self) -> DataFrame:
        day = testfeeds.SECOND_LOAD
        return scd2.apply_scd2(self.supplier_first_load(), self.supplier_snapshot(day), day)

    def build(self, name: str) -> DataFrame:
        """The plan of one gold table over its stored inputs."""
        if name == "dim_supplier":
            return self.build_supplier()
        if name in ("dim_meal_period", "dim_waste_reason"):
            return getattr(dims, name)(self.spark)
        if name == "dim_date":
            return dims.dim_date_covering(self.silver_for(name))
        if name in DIMS:
            return getattr(dims, name)(self.silver_for(name))
        if name in FACTS:
            return build_fact(name, self.silver_for(name), self.lookups(FACTS[name].names), "all", self.stage)
        raise KeyError(name)

    def lookups(self, columns: Iterable[str]) -> dict[str, DataFrame]:
        """The stored dimensions that give the surrogate keys in ``columns``."""
        wanted = [facts.DIM_OF[c] for c in columns if c in facts.DIM_OF]
        return {name: sent_if_small(self[name]) for name in wanted}

    def planned(self, name: str) -> DataFrame:
        """A gold table for one pass over few of its columns: a fact that is not stored is not stored
        for it, and Spark computes these columns only."""
        return self.build(name) if name in FACTS and name not in self._stored else self[name]

    def waste_of(self, year: int, *columns: str) -> Mapping[str, DataFrame]:
        """The gold tables for a question about one year that needs few columns of the waste: unless it is
        stored, it is planned with these and that year, and other dimensions are not built for it."""
        if "fact_waste" in self._stored:
            return self
        tables = self.lookups([*columns, "supplier_sk"])
        source = self._stored_silver(_FEW["fact_waste"], year)
        if source is None:
            source = self.build_silver(_FEW["fact_waste"], year)
        waste = facts.fact_waste(source.where(F.col("year") == year), tables, stage=self.stage, columns=columns)
        return ChainMap({"fact_waste": waste}, tables, self)

    def of_year(self, year: int, *names: str) -> Mapping[str, DataFrame]:
        """The gold tables for a question about one year: of the named facts, those that are not stored are
        planned over the rows of that year, which are stored once with the columns that facts need."""
        wanted = [name for name in names if name not in self._stored]
        if not wanted:
            return self
        source = self.silver_of_facts(year)

        def fact(name: str) -> DataFrame:
            built = build_fact(name, source, self.lookups(FACTS[name].names), "all", self.stage)
            # The summary is few rows, which marts read several times.
            return self._table(f"{name}_{year}", lambda: built) if name == "fact_waste_summary" else built

        return ChainMap({name: fact(name) for name in wanted}, self)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in DIMS and name not in FACTS:
            raise KeyError(name)
        return self._table(name, lambda: self.build(name))

    def __iter__(self) -> Iterator[str]:
        return iter([*DIMS, *FACTS])

    def __len__(self) -> int:
        return len(DIMS) + len(FACTS)


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.conf.get("spark.app.id"), sf_dir)
    with _lock:
        if key not in _open:
            _open[key] = Workspace(spark, sf_dir)
        return _open[key]


__all__ = ["Workspace", "workspace"]
