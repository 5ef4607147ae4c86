"""Query registry: a name, a function of (spark, folder) and, where possible, equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolake.plans.sql_views import with_views
from ludolake.plans.views import Lake
from ludolake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of one ``Lake``. The SQL may use the view names of ``sql_views``."""
    def add(fn: Callable[[Lake], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Lake(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return add


_written: dict[tuple, str] = {}


def _state(lake: Lake) -> tuple:
    """Number, bytes and newest change of the files below the data folder; reads the listing only."""
    files = lake.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(lake.sf_dir)
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime")).first())


def written_once(lake: Lake, label: str, write: Callable[[str], object]) -> str:
    """Path of a derived data set, written by ``write`` on first use in this application.

    It is written again when the tables have changed since.
    """
    key = (lake.spark.sparkContext.applicationId, lake.sf_dir, label, _state(lake))
    if key not in _written:
        path = scratch_path(lake.spark, label)
        write(path)
        _written[key] = path
    return _written[key]
