"""Upserts and tables kept in numbered versions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rollcall.operators.windows import keep_first
from rollcall.sources.files import delete_path, path_exists

HISTORY_SCHEMA = "version int, timestamp timestamp, operation string, base int"


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], latest_first: list[Column] | None = None
) -> DataFrame:
    """Target with the source's values on matching keys, plus the source's new keys.

    Columns the source does not have keep the target's values (null in new rows).
    A target row that several source rows match is an error, raised when the result
    is made, unless ``latest_first`` tells which of them counts. Source rows of a
    new key are all added. A null key matches nothing.

    One full join: both tables are read once. The number of source rows of a key is
    counted in the partitions that the join needs anyway.
    """
    if latest_first:
        source = keep_first(source, keys, [*latest_first, *[F.desc_nulls_last(c) for c in source.columns if c not in keys]])
    shared = [c for c in source.columns if c in target.columns and c not in keys]
    changes = source.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_s_{c}") for c in shared], F.lit(True).alias("_hit"),
        F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("_n"),
    )
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    joined = target.withColumn("_there", F.lit(True)).join(changes, on, "full_outer")
    twice = F.col("_there") & F.col("_hit") & (F.col("_n") > 1)
    refused = F.raise_error(F.lit("several source rows match one row of the target")).cast("boolean")
    hit = F.coalesce("_hit", F.lit(False))
    return joined.filter(F.when(twice, refused).otherwise(F.lit(True))).select(
        *[
            F.coalesce(c, f"_k_{c}").alias(c) if c in keys
            else F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in shared
            else F.col(c)
            for c in target.columns
        ]
    )


def append_shifted(df: DataFrame, order: list[str], rows: int = 100, days: int = 365) -> DataFrame:
    """The table plus its first rows again, dated ``days`` later."""
    head = df.orderBy(*order).limit(rows)
    shifted = head.withColumn("date", F.date_add(F.col("date").cast("date"), days))
    return df.withColumn("date", F.col("date").cast("date")).unionByName(shifted)


def add_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, value)


def random_score(seed: int = 0) -> Column:
    """A random figure from 0 to 100 with one decimal."""
    return F.round(F.rand(seed) * 100, 1)


class VersionedTable:
    """A Parquet table whose earlier versions stay readable.

    Every write goes to its own ``v=<n>`` folder, and then one row is added to a
    small history. A write that dies half-way has no history row and is never
    read; a repeated one replaces its folder. An append adds a folder to the
    version before it; a rewrite starts a new base. Versions start at 0. There is
    one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- reading
    def history(self) -> DataFrame:
        """One row per write: version, timestamp, operation, base."""
        if not path_exists(self.spark, f"{self.root}/history"):
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(f"{self.root}/history")

    def _entry(self, version: int | None):
        log = self.history()
        if version is not None:
            log = log.filter(F.col("version") == version)
        return log.orderBy(F.desc("version")).first()

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, the newest by default."""
        entry = self._entry(version)
        if entry is None:
            raise ValueError(f"no version {version} of {self.root}")
        folders = [f"{self.root}/v={n}" for n in range(entry["base"], entry["version"] + 1)]
        return self.spark.read.option("mergeSchema", len(folders) > 1).parquet(*folders)

    # --- writing
    def _commit(self, df: DataFrame, operation: str, rewrite: bool, at: datetime | None) -> int:
        last = self._entry(None)
        version = 0 if last is None else last["version"] + 1
        base = version if rewrite or last is None else last["base"]
        df.write.mode("overwrite").parquet(f"{self.root}/v={version}")
        row = [(version, at or datetime.now(), operation, base)]
        entry = self.spark.createDataFrame(row, HISTORY_SCHEMA).coalesce(1)
        entry.write.mode("append").parquet(f"{self.root}/history")
        return version

    def overwrite(self, df: DataFrame, at: datetime | None = None) -> int:
        return self._commit(df, "WRITE", True, at)

    def append(self, df: DataFrame, at: datetime | None = None) -> int:
        """Write only the new rows; they may have additional columns."""
        return self._commit(df, "APPEND", False, at)

    def merge(
        self,
        source: DataFrame,
        keys: list[str],
        latest_first: list[Column] | None = None,
        at: datetime | None = None,
    ) -> int:
        """Upsert into a new version; the version being read is not touched."""
        return self._commit(upsert(self.read(), source, keys, latest_first), "MERGE", True, at)

    def evolve(self, name: str, value: Column, at: datetime | None = None) -> int:
        return self._commit(add_column(self.read(), name, value), "ADD COLUMN", True, at)

    def compact(self, files: int, at: datetime | None = None) -> int:
        """The same rows in about ``files`` files of equal size."""
        return self._commit(self.read().repartition(files), "OPTIMIZE", True, at)

    def purge(self, keep_from: int) -> list[int]:
        """Delete folders that no version from ``keep_from`` on reads."""
        entry = self._entry(keep_from)
        if entry is None:
            raise ValueError(f"no version {keep_from}")
        gone = [n for n in range(entry["base"]) if path_exists(self.spark, f"{self.root}/v={n}")]
        for n in gone:
            delete_path(self.spark, f"{self.root}/v={n}")
        return gone
