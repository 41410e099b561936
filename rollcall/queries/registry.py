"""Registry of named queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.queries.views import reference_sql

QueryFunction = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFunction] = {}
REFERENCE_SQL: dict[str, str] = {}


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which every client reads alike."""
    text = {c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"}
    return df.withColumns(text) if text else df


def query(name: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query; ``sql`` may use the views of ``rollcall.queries.views``."""

    def register(function: QueryFunction) -> QueryFunction:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: dates_as_text(function(spark, sf_dir))
        if sql is not None:
            REFERENCE_SQL[name] = reference_sql(sql)
        return function

    return register
