"""The list of named queries: a Spark form, and a SQL form where one exists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.plans.bindings import Tables


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function of :class:`Tables` under its own name."""

    def add(run: Callable[[Tables], DataFrame]):
        name = run.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, run, sql)
        return run

    return add


def r(column: str | Column, digits: int = 6, name: str | None = None) -> Column:
    """Rounded column; ``+ 0.0`` turns a negative zero into zero."""
    col = F.col(column) if isinstance(column, str) else column
    out = F.round(col, digits) + F.lit(0.0)
    if name is None and isinstance(column, str):
        name = column
    return out.alias(name) if name else out
