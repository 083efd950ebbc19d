"""Every operator as a query over the driver's tables, with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    from . import balance, columns, files, groups, models, ratings, tables

    found: dict[str, Query] = {}
    for module in (columns, files, tables, groups, models, ratings, balance):
        for name, fn in module.QUERIES.items():
            found[name] = _configured(fn)
    return found


def all_oracles() -> dict[str, str]:
    from . import balance, columns, files, groups, models, ratings, tables

    return {k: v for m in (columns, files, tables, groups, models, ratings, balance) for k, v in m.ORACLES.items()}


def _configured(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
