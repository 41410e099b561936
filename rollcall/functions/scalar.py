"""Scalar expressions shared by the operators.

Every helper takes and returns a ``Column``. The null rules are the ones a
dataframe library user expects (a missing value stays missing unless it is
filled on purpose), which is not always what the nearest Spark built-in does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- parsing -----------------------------------------------------------------

def parse_date(c: ColumnLike) -> Column:
    """Date, or null where the text is not a date."""
    return as_col(c).try_cast("date")


def parse_timestamp(c: ColumnLike) -> Column:
    """Timestamp from ISO-8601 text, or null."""
    return F.try_to_timestamp(as_col(c))


def parse_number(c: ColumnLike, default: float | None = 0.0) -> Column:
    """Double, with ``default`` where the text is not a number."""
    number = as_col(c).try_cast("double")
    return number if default is None else F.coalesce(number, F.lit(default))


# --- dates -------------------------------------------------------------------

def year_month(c: ColumnLike) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def month_start(c: ColumnLike) -> Column:
    return F.trunc(as_col(c), "MM")


def date_key(c: ColumnLike) -> Column:
    """Integer yyyymmdd."""
    d = as_col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def weekday_number(c: ColumnLike) -> Column:
    """Monday is 0."""
    return F.weekday(as_col(c))


def is_weekend(c: ColumnLike) -> Column:
    return F.weekday(as_col(c)) >= 5


def day_name(c: ColumnLike) -> Column:
    return F.date_format(as_col(c), "EEEE")


def month_name(c: ColumnLike) -> Column:
    return F.date_format(as_col(c), "MMMM")


def iso_week(c: ColumnLike) -> Column:
    return F.weekofyear(as_col(c))


def window_number(ts: ColumnLike, seconds: int) -> Column:
    """Index of the fixed-width window that an instant falls into."""
    return F.floor(F.unix_timestamp(as_col(ts)) / F.lit(seconds)).cast("bigint")


# --- numbers -----------------------------------------------------------------

def clip(c: ColumnLike, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high]; null stays null (``least``/``greatest`` would drop it)."""
    x = as_col(c)
    out = F.when(F.lit(False), x)
    if low is not None:
        out = out.when(x < low, F.lit(float(low)))
    if high is not None:
        out = out.when(x > high, F.lit(float(high)))
    return out.otherwise(x)


def clamp_filled(c: ColumnLike, low: float, high: float, fill: float = 0.0) -> Column:
    """Fill null, then limit to [low, high]."""
    return F.least(F.greatest(F.coalesce(as_col(c), F.lit(fill)), F.lit(low)), F.lit(high))


def round_to(c: Column, digits: int | None, half_even: bool = False) -> Column:
    """Round, or leave alone when ``digits`` is None.

    ``half_even`` follows dataframe libraries, the default follows SQL.
    """
    if digits is None:
        return c
    return F.bround(c, digits) if half_even else F.round(c, digits)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole; null when whole is 0."""
    return F.try_divide(F.lit(100.0) * part, whole)


def percent_text(part: Column, whole: Column) -> Column:
    """One decimal and a percent sign, ``N/A`` when there is nothing to divide by."""
    return F.when(whole == 0, F.lit("N/A")).otherwise(
        F.format_string("%.1f%%", percent(part, whole))
    )


def log1p_nonneg(c: ColumnLike) -> Column:
    return F.log1p(clip(c, low=0.0))


def overtime(c: ColumnLike, standard: float = 8.0, digits: int | None = 2) -> Column:
    """Hours above the standard day, never negative; unknown for unknown hours."""
    return F.when(as_col(c).isNotNull(), F.greatest(F.lit(0.0), round_to(as_col(c) - F.lit(standard), digits)))


def productivity(
    c: ColumnLike, floor: float | None = 0.0, digits: int | None = 3, half_even: bool = True
) -> Column:
    """Share of an eight-hour day, at most 1.5; ``floor=None`` lets it go below zero."""
    return round_to(clip(as_col(c) / F.lit(8.0), floor, 1.5), digits, half_even)


# --- predicates, categories ----------------------------------------------------

def is_true(cond: Column) -> Column:
    """A predicate with unknown read as false."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def status_is(value: str, c: ColumnLike = "status") -> Column:
    return is_true(as_col(c) == value)


def lookup(c: ColumnLike, table: dict[str, float | int | str]) -> Column:
    """Value for a key from a small fixed table; null for an unknown key."""
    x = as_col(c)
    out = F.when(F.lit(False), F.lit(None))
    for key, value in table.items():
        out = out.when(x == key, F.lit(value))
    return out


def right_closed_bins(c: ColumnLike, edges: list[float], labels: list[str]) -> Column:
    """Label of the bin (lo, hi] holding the value; the last bin has no upper end.

    ``edges`` holds the lower end of the first bin and the upper end of every
    bin but the last, so it is as long as ``labels``. At or below the first
    edge, and for null, there is no label.
    """
    if len(edges) != len(labels):
        raise ValueError("one edge per label")
    x = as_col(c)
    out = F.when(x.isNull() | (x <= edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels[:-1]):
        out = out.when(x <= upper, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def salary_band(c: ColumnLike = "salary") -> Column:
    # Salary band edges and names.
    return right_closed_bins(c, [0, 40000, 80000, 150000], ["Junior", "Mid", "Senior", "Executive"])


def budget_tier(c: ColumnLike = "budget") -> Column:
    # Budget tier edges and names.
    return right_closed_bins(c, [0, 1000000, 3000000], ["Small", "Medium", "Large"])


def clean_text(c: ColumnLike) -> Column:
    return F.trim(F.lower(as_col(c)))


# --- rows as text, hashing -----------------------------------------------------

def row_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    return F.to_json(F.struct(*(columns or df.columns)))


def hash_fraction_below(key: ColumnLike, fraction: float, seed: int = 0) -> Column:
    """True for about ``fraction`` of all keys, always the same ones.

    Compares leading hexadecimal digits of a digest, so the choice does not
    depend on partitioning, on a re-run task or on the engine.
    """
    threshold = format(min(int(fraction * 2**32), 2**32 - 1), "08x")
    digest = F.md5(F.concat(as_col(key).cast("string"), F.lit(f"#{seed}")))
    return F.substring(digest, 1, 8) < threshold


def partition_number(key: ColumnLike, partitions: int) -> Column:
    """Partition of a key: the same key always lands in the same partition."""
    digest = F.md5(as_col(key).cast("string"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(partitions)).cast("int")
