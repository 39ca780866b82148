"""One place that knows every query, what it reads and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomstat.plans.inputs import Inputs
from loomstat.plans.views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``function(inputs) -> DataFrame`` under ``name``, with the SQL text that gives the same rows."""

    def register(function: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: function(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return function

    return register
