"""Stored intermediates and the Python path of workers."""

from __future__ import annotations

import atexit
import os
import threading

from pyspark.sql import DataFrame, SparkSession

from larder.sources import files

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_left: list[tuple[SparkSession, str]] = []
_lock = threading.Lock()


def workers_find_package(spark: SparkSession) -> None:
    """Put this package's folder on the path of Python workers that are started from now on.

    Workers on other machines need the package installed, as with any PySpark code.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, known)])


class Stored:
    """Tables written to the shared folder, so that lineage ends at files every executor reads.

    ``drop`` removes one table as soon as nothing reads it; ``clear`` removes all. What a
    returned DataFrame still reads stays until the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{files.shared_folder(spark)}/{files.new_name(name)}"
        self._paths: dict[int, str] = {}
        self._n = 0
        with _lock:
            _left.append((spark, self.folder))

    def write(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return the table read back."""
        self._n += 1
        path = f"{self.folder}/{self._n}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(table)] = path
        table._stored_path = path
        return table

    def drop(self, table: DataFrame) -> None:
        files.delete(self.spark, table._stored_path)

    def clear(self) -> None:
        files.delete(self.spark, self.folder)


@atexit.register
def _clear_all() -> None:
    with _lock:
        for spark, folder in _left:
            if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
                continue
            files.delete(spark, folder)
        _left.clear()
