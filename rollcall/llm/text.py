"""Expressions over whole texts that several operators share. All are built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

BLANKS = r"[ \t-\r]"  # the blank and U+0009 to U+000D


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The runs of characters other than the blank and U+0009 to U+000D; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS + "+"), "")


def number_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    return F.regexp_count(text, F.lit("[" + characters + "]"))


def lines_of(text: Column) -> Column:
    """The lines of a text that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^ \t-\r]"))


def need(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that columns of the caller cannot clash with the operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])
