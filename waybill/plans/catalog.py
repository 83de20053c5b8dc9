"""Every query by name: what Spark runs, and the SQL that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from waybill.sources.files import spread

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str | None = None


CATALOG: dict[str, Query] = {}


def query_in(
    catalog: dict[str, Query], sql: str | None = None, name: str | None = None
) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        catalog[name or run.__name__] = Query(run, sql)
        return run

    return add


query = functools.partial(query_in, CATALOG)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows take long to work on."""
    return spread(table(spark, sf_dir, name))
