"""Column statistics, exact quantiles and normalisation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from rollcall.functions.scalar import log1p_nonneg, round_to
from rollcall.operators.quantiles import column_quantiles, quantile_name
from rollcall.operators.relational import existing

INTEGERS = ("tinyint", "smallint", "int", "bigint")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# --- exact quantiles ---------------------------------------------------------------

def exact_quantiles(df: DataFrame, column: str, probs: list[float]) -> DataFrame:
    """One row with the exact quantiles as ``p25``, ``p50``, ..."""
    return column_quantiles(df, [column], probs).select(*map(quantile_name, probs))


def _lit(value: float | None) -> Column:
    return F.lit(value).cast("double")


def as_struct(one_row: DataFrame) -> Column:
    """A one-row table as a scalar subquery returning a struct."""
    return one_row.select(F.struct(*one_row.columns)).scalar()


# --- normalisation -----------------------------------------------------------------

def _min_max(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    stats = as_struct(
        df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
    )
    out = {}
    for c in columns:
        lo, hi = stats[f"lo_{c}"], stats[f"hi_{c}"]
        out[c] = F.when(hi == lo, F.lit(0.0)).otherwise((F.col(c) - lo) / F.nullif(hi - lo, F.lit(0)))
    return out


def _z_score(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    stats = as_struct(
        df.agg(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_samp(c).alias(f"std_{c}") for c in columns],
        )
    )
    out = {}
    for c in columns:
        mean, std = stats[f"mean_{c}"], stats[f"std_{c}"]
        out[c] = F.when(std == 0, F.lit(0.0)).otherwise((F.col(c) - mean) / F.nullif(std, F.lit(0.0)))
    return out


def _robust(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    found = {r["column"]: r for r in column_quantiles(df, columns, [0.25, 0.5, 0.75]).collect()}
    out = {}
    for c in columns:
        q = found[c]
        if q["p50"] is None:
            out[c] = _lit(None)
        elif q["p75"] == q["p25"]:
            out[c] = F.lit(0.0)
        else:
            out[c] = (F.col(c) - F.lit(q["p50"])) / F.lit(q["p75"] - q["p25"])
    return out


def _log(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    return {c: log1p_nonneg(c) for c in columns}


METHODS = {"min_max": _min_max, "z_score": _z_score, "robust_scale": _robust, "log_transform": _log}


def normalize_columns(df: DataFrame, columns: list[str], method: str = "min_max") -> DataFrame:
    """Add ``<column>_norm`` for each listed column that exists.

    The statistics of all columns come from one aggregation and reach the rows
    as a scalar subquery, quartiles as constants. A constant column becomes 0, in rows without a value too.
    """
    present = existing(df, columns)
    if not present:
        return df
    scaled = METHODS[method](df, present)
    return df.withColumns({f"{c}_norm": e for c, e in scaled.items()})


# --- descriptions ------------------------------------------------------------------

def column_statistics(df: DataFrame, column: str) -> DataFrame:
    """Count, moments (population), extremes and five percentiles of a column."""
    v = F.col("_v")
    figures = {"mean": F.avg(v), "std": F.stddev_pop(v), "variance": F.var_pop(v), "min": F.min(v), "max": F.max(v)}
    probs = [0.25, 0.5, 0.75, 0.9, 0.99]
    found = column_quantiles(df, [column], probs, also=figures)
    return found.select("n", *figures, F.col("p50").alias("median"), *map(quantile_name, probs))


def describe_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, a row per column; all columns share two scans."""
    v = F.col("_v")
    figures = {"mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}
    found = column_quantiles(df, columns, [0.25, 0.5, 0.75], also=figures)
    return found.select("column", F.col("n").alias("count"), *figures, "p25", "p50", "p75")


def describe_numeric(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of a column."""
    return describe_numbers(df, [column]).drop("column")


def describe_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct values, the most frequent value (the smallest of equally frequent ones) and its count.

    A row per column. Values of all columns are counted in one scan.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("_column"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)])
    counts = df.select(F.inline(cells)).groupBy("_column", "v").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("v").isNotNull()
    per_column = counts.groupBy("_column").agg(
        F.sum(F.when(known, F.col("n"))).alias("count"), F.count("v").alias("distinct"),
        F.min(F.when(known, F.struct((-F.col("n")).alias("n"), "v"))).alias("best"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "_column int, column string")
    return names.join(per_column, "_column", "left").select(
        "column", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("distinct", F.lit(0)).alias("distinct"),
        F.col("best.v").alias("top"), (-F.col("best.n")).alias("freq"))


def describe_all(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: count; distinct, top and freq of text; statistics of numbers."""
    columns = columns or df.columns
    numbers = [c for c in columns if c in set(numeric_columns(df))]
    texts = [c for c in columns if c not in numbers]
    figures = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    order = ["column", "count", "distinct", "top", "freq", *figures]
    parts = []
    if numbers:
        empty = {"distinct": F.lit(None).cast("bigint"), "top": F.lit(None).cast("string"), "freq": F.lit(None).cast("bigint")}
        parts.append(describe_numbers(df, numbers).withColumns(empty).select(*order))
    if texts:
        parts.append(describe_texts(df, texts).withColumns({f: F.lit(None).cast("double") for f in figures}).select(*order))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def iqr_outliers(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Number of values outside the quartiles by more than ``factor`` IQR, and the valid range.

    ``rows`` counts all rows, those without a value included.
    """
    q = column_quantiles(df, [column], [0.25, 0.75]).first()
    if q["p25"] is None:
        low, high = _lit(None), _lit(None)
    else:
        reach = factor * (q["p75"] - q["p25"])
        low, high = F.lit(q["p25"] - reach), F.lit(q["p75"] + reach)
    value = F.col(column).cast("double")
    counted = df.agg(F.count_if((value < low) | (value > high)).alias("outliers"), F.count(F.lit(1)).alias("rows"))
    return counted.select("outliers", "rows", low.alias("lower"), high.alias("upper"))


def correlations(df: DataFrame, columns: list[str] | None = None, digits: int | None = 3) -> DataFrame:
    """Pearson correlation of each pair of numeric columns, over rows where both are known."""
    columns = columns or numeric_columns(df)
    pairs = list(combinations(columns, 2))
    if not pairs:
        raise ValueError("two numeric columns are needed")
    one = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("column_a"),
                F.lit(b).alias("column_b"),
                round_to(F.col(f"r{i}"), digits, half_even=True).alias("correlation"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return one.select(F.inline(rows))


# --- narrow types --------------------------------------------------------------------

def _int_limits(bits: int) -> tuple[int, int]:
    return -(2 ** (bits - 1)), 2 ** (bits - 1) - 1


def type_advice(df: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Narrowest integer type per integer column, float for doubles, and text worth a dictionary.

    Extremes of all integer columns come from one aggregation. Distinct text
    values are counted one column at a time, each from a scan of that column.
    """
    ints = [c for c, t in df.dtypes if t in INTEGERS]
    doubles = [c for c, t in df.dtypes if t == "double"]
    texts = [c for c, t in df.dtypes if t == "string"]
    kinds = "column string, current string, advice string, low_cardinality boolean"
    parts = []
    if ints or doubles:
        one = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.min(c).alias(f"lo_{c}") for c in ints],
            *[F.max(c).alias(f"hi_{c}") for c in ints],
        )
        structs = []
        for c in ints:
            advice = F.lit("bigint")
            for name, bits in (("int", 32), ("smallint", 16), ("tinyint", 8)):
                low, high = _int_limits(bits)
                fits = (F.col(f"lo_{c}") >= low) & (F.col(f"hi_{c}") <= high)
                advice = F.when(fits, F.lit(name)).otherwise(advice)
            structs.append(_advice(c, dict(df.dtypes)[c], advice, F.lit(None).cast("boolean")))
        for c in doubles:
            structs.append(_advice(c, "double", F.lit("float"), F.lit(None).cast("boolean")))
        parts.append(one.select(F.inline(F.array(*structs))))
    for c in texts:
        counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        ratio = F.try_divide(F.count(c), F.sum("_n"))
        parts.append(
            counts.agg((ratio < threshold).alias("_low")).select(
                F.inline(F.array(_advice(c, "string", F.lit("string"), F.col("_low"))))
            )
        )
    if not parts:
        return df.sparkSession.createDataFrame([], kinds)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _advice(column: str, current: str, advice: Column, low: Column) -> Column:
    return F.struct(
        F.lit(column).alias("column"),
        F.lit(current).alias("current"),
        advice.alias("advice"),
        low.alias("low_cardinality"),
    )


def narrow_integers(df: DataFrame) -> DataFrame:
    """Cast integer columns to the narrowest type that holds their values.

    The extremes (one row) are read first: a column type has to be known when
    the plan is made.
    """
    ints = [c for c, t in df.dtypes if t in INTEGERS]
    if not ints:
        return df
    row = df.agg(*[F.min(c).alias(f"lo_{c}") for c in ints], *[F.max(c).alias(f"hi_{c}") for c in ints]).first()
    casts = {}
    for c in ints:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        if lo is None:
            continue
        for name, bits in (("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64)):
            low, high = _int_limits(bits)
            if low <= lo and hi <= high:
                casts[c] = F.col(c).cast(name)
                break
    return df.withColumns(casts)
