"""Batch scans with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from rollcall.operators.quality import table_shape
from rollcall.schemas import TABLES
from rollcall.sources.files import list_names, path_exists

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, keep_corrupt: bool = False) -> DataFrame:
    """CSV with a header. Large files are split into tasks by byte range.

    ``keep_corrupt`` adds the text of lines that do not fit the schema. Without
    a schema the types are inferred, which reads the file twice.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_directory(spark: SparkSession, folder: str, register: bool = True) -> dict[str, DataFrame]:
    """Every ``<name>.csv`` below a folder as a table of that name, also as a temp view."""
    tables = {}
    for entry in list_names(spark, folder):
        if not entry.endswith(".csv"):
            continue
        name = entry[: -len(".csv")]
        tables[name] = read_csv(spark, f"{folder.rstrip('/')}/{entry}", TABLES.get(name))
        if register:
            tables[name].createOrReplaceTempView(name)
    return tables


def directory_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and missing cells of each table."""
    out = None
    for name, df in tables.items():
        part = table_shape(df).select(F.lit(name).alias("table"), "rows", "columns", "missing")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no tables")
    return out


def load_table(spark: SparkSession, name: str, csv_path: str | None = None) -> DataFrame:
    """The stored table, else its CSV file, else an empty table."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    schema = TABLES.get(name, T.StructType([]))
    if csv_path and path_exists(spark, csv_path):
        return read_csv(spark, csv_path, TABLES.get(name))
    return spark.createDataFrame([], schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A file holding one JSON array."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
