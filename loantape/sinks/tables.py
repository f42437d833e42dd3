"""Writing tables and describing them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loantape.operators.skew import hot_groups, null_safe, sort_rows

# Rows of a bucket, which one task sorts: at some 1 KB each in memory, what it holds without a spill.
BUCKET_ROWS = 500_000
# Rows staged for a later step take a fifth less disk so than by the default.
STORED = "zstd"


def write_monthly(monthly: DataFrame, path: str) -> DataFrame:
    """Store the monthly table as Parquet, replacing it, and read it back.

    Rows stay where they were read; the rollup does the one shuffle there is.
    """
    monthly.write.mode("overwrite").option("compression", STORED).parquet(path)
    return monthly.sparkSession.read.schema(monthly.schema).parquet(path)


def bucket_monthly(
    monthly: DataFrame, table: str, path: str, keys: Iterable[str], limit: int, buckets: int | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """A stored monthly table kept as the catalog's ``table``, bucketed and sorted by ``keys``, and
    what does not go into buckets: the rows of groups with more than ``limit`` rows, or ``None``.

    One shuffle here, in place of one in each aggregation by ``keys`` or in each join of tables with
    as many buckets (``buckets``, by default one per ``BUCKET_ROWS``). A group is in one bucket
    whole, so those that one task could not hold stay apart, as a Parquet table that Spark shuffles
    with its partial aggregates. Both lie below ``path``; an existing ``table`` is replaced. NULL keys
    are groups like any other.
    """
    keys = list(keys)
    spark = monthly.sparkSession
    long = hot_groups(monthly, keys, limit)
    rows, rest = monthly, None
    if long is not None:
        match = null_safe(monthly, long, keys)
        rows = monthly.join(long, match, "left_anti")
        rest = write_monthly(monthly.join(long, match, "left_semi"), f"{path}/long")
    if buckets is None:
        buckets = max(spark.sparkContext.defaultParallelism, -(-monthly.count() // BUCKET_ROWS))
    spark.sql(f"drop table if exists `{table}`")
    # Spread as the buckets are, so that a task writes one of them, in one file.
    spread = rows.repartition(buckets, *keys).write.mode("overwrite").option("path", f"{path}/buckets")
    spread.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table, format="parquet")
    return spark.table(table), rest


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def append_runs(standard: DataFrame, other: DataFrame) -> DataFrame:
    """The rows of two runs in one table."""
    return standard.unionByName(other)


def write_id_map(id_map: DataFrame, path: str) -> DataFrame:
    """Store the id map, always from scratch."""
    id_map.write.mode("overwrite").parquet(path)
    return id_map.sparkSession.read.schema(id_map.schema).parquet(path)


def primary_order(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows in key order, in ranges of the key, so that files written hold narrow key ranges."""
    return sort_rows(df, keys)


def _flat(schema: T.StructType) -> list[tuple[str, str, str]]:
    rows = []
    for field in schema.fields:
        kind = field.dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            rows += [
                (f"{field.name}.{f.name}", f"array<{f.dataType.simpleString()}>", _comment(f))
                for f in kind.elementType.fields
            ]
        else:
            rows.append((field.name, kind.simpleString(), _comment(field)))
    return rows


def _comment(field: T.StructField) -> str:
    return (field.metadata or {}).get("comment", "")


def describe(df: DataFrame) -> DataFrame:
    """Position, name, type and description of each column; nested tables column by column."""
    rows = [(i, *row) for i, row in enumerate(_flat(df.schema))]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, comment string"
    )


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return describe(spark.table(table))


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``df`` with exactly the expected columns, types and descriptions; raises if it cannot be."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError("column names are not unique")
    lacking = [f.name for f in expected.fields if f.name not in df.columns]
    if lacking:
        raise ValueError(f"columns missing: {lacking}")
    return df.select(*[F.col(f"`{f.name}`") for f in expected.fields]).to(expected)
