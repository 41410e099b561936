"""Batch sinks."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollcall.sources.files import delete_path, list_names


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_run_date(df: DataFrame, path: str, run_date: date, column: str = "ds") -> None:
    """Replace the partition of one run date and leave the others, so a run may be repeated."""
    (
        df.withColumn(column, F.lit(run_date.isoformat()))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_report(one_row: DataFrame, path: str) -> None:
    """A report of a few rows as a single JSON file."""
    one_row.coalesce(1).write.mode("overwrite").json(path)


def write_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> None:
    """Replace or append a catalog table, at ``path`` when one is given."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 10_000, **options: str) -> None:
    """Rows into a database table in batches."""
    df.write.format("jdbc").mode(mode).options(
        url=url, dbtable=table, batchsize=str(batch), **options
    ).save()


def create_table_as(
    spark: SparkSession, name: str, query: str, path: str | None = None, **tables: DataFrame
) -> None:
    """Store the result of a query, replacing the table. ``tables`` fill ``{name}`` in the query."""
    write_table(spark.sql(query, **tables), name, "overwrite", path)


def _date_parts(column: str, depth: int) -> dict[str, Column]:
    parts = {
        "year": F.date_format(column, "yyyy"),
        "month": F.date_format(column, "MM"),
        "day": F.date_format(column, "dd"),
    }
    return dict(list(parts.items())[:depth])


def write_by_day(df: DataFrame, path: str, column: str = "date", mode: str = "overwrite", depth: int = 3) -> None:
    """Folders ``year=/month=/day=`` (fewer with a smaller ``depth``) on any file system.

    Rebalancing brings the rows of a day together, merges small days into one
    task and splits a day with very many rows over several, so files come out at
    about the advisory partition size.
    """
    parts = _date_parts(column, depth)
    (
        df.withColumns(parts)
        .hint("rebalance", *parts)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def write_daily_monthly(df: DataFrame, root: str, column: str = "date") -> None:
    """The same rows laid out by day and by month."""
    write_by_day(df, f"{root}/daily", column, depth=3)
    write_by_day(df, f"{root}/monthly", column, depth=2)


def archive_closed(df: DataFrame, path: str, as_of: date, delivery: str, column: str = "date") -> DataFrame:
    """Put the rows of closed months under ``year=/month=/delivery=`` and return the open rest.

    A late row joins those archived for its month before, under the name of its own
    delivery. The same delivery again replaces what it wrote, so a job may be
    repeated after a failure.
    """
    first = F.lit(as_of.replace(day=1))
    months = _date_parts(column, 2)
    (
        df.filter(F.col(column) < first)
        .withColumns({**months, "delivery": F.lit(delivery)})
        .hint("rebalance", *months)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*months, "delivery")
        .parquet(path)
    )
    return df.filter((F.col(column) >= first) | F.col(column).isNull())


def retained(df: DataFrame, as_of: date, days: int = 7, column: str = "date") -> DataFrame:
    """Rows no older than ``days`` before ``as_of``; rows without a date stay."""
    return df.filter((F.col(column) >= F.lit(as_of - timedelta(days=days))) | F.col(column).isNull())


def expire_partitions(
    spark: SparkSession, path: str, as_of: date, days: int = 7, column: str = "ds"
) -> list[str]:
    """Delete run-date partitions older than ``days``; returns the dates removed."""
    limit = (as_of - timedelta(days=days)).isoformat()
    prefix = f"{column}="
    old = [n for n in list_names(spark, path) if n.startswith(prefix) and n[len(prefix):] < limit]
    for name in old:
        delete_path(spark, f"{path}/{name}")
    return [n[len(prefix):] for n in old]
