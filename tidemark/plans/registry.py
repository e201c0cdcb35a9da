"""All queries of the forecasting engine, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
MODULES = ("calendar", "lake", "quality", "features", "forecasts", "serving", "streams")


def query(name: str, sql: str | None = None):
    """Register a query under its name; ``sql`` gives the same rows in DuckDB.

    Both sides round measures to 6 places after adding 1e-9: sums differ in their last bits by the order of
    addition, and means of prices often end in an exact half of the sixth place.
    """

    def add(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.replace(", 6)", " + 1e-9, 6)")
        return build

    return add


def _load() -> None:
    for module in MODULES:
        import_module(f"tidemark.plans.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
