"""Pieces the query modules share."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

AS_OF = date(2001, 7, 31)  # end of the period the orders cover
EV_AS_OF = date(2024, 1, 31)  # end of the period the events cover


def six_digits(c: Column | str) -> Column:
    """A figure cut to six decimals, for results whose last bits depend on the order of addition."""
    x = F.col(c) if isinstance(c, str) else c
    return x.cast("decimal(38,6)").cast("double")


def six_digit_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: six_digits(n) for n in names})


def wall_time(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps without a zone, as the input tables have them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
