"""JDBC edges (A2, A4): parallel reads and typed writes.

Staging and core tables of a relational store are read with Spark's
partitioned JDBC reader -- one task per key range, not one task for the
whole table -- and written with batching. Connection settings (URL, user,
password, driver class) are the caller's; nothing is defaulted here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    *,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    predicates: list[str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A2: read a table (or a parenthesised subquery) in parallel.

    Give either a numeric ``partition_column`` with bounds (Spark splits the
    range into ``num_partitions`` strides) or explicit ``predicates`` (one
    partition each, e.g. one per date). Filters and column pruning applied
    afterwards are pushed into the generated SQL by Spark.
    """
    props = dict(properties, fetchsize=str(fetch_size))
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    if partition_column is not None:
        return spark.read.jdbc(
            url,
            table,
            column=partition_column,
            lowerBound=lower_bound,
            upperBound=upper_bound,
            numPartitions=num_partitions,
            properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)


def jdbc_ready(df: DataFrame) -> DataFrame:
    """Encode what a JDBC target cannot take: structs, arrays and maps become
    JSON text, untyped nulls become typed string nulls."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, T.NullType):
            c = c.cast(T.StringType())
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    *,
    mode: str = "append",
    batch_size: int = 10_000,
    num_partitions: int | None = None,
) -> None:
    """A4: write ``df`` to a table; ``num_partitions`` caps concurrent
    connections to the target."""
    out = jdbc_ready(df)
    if num_partitions:
        out = out.coalesce(num_partitions)
    props = dict(properties, batchsize=str(batch_size))
    out.write.jdbc(url, table, mode=mode, properties=props)


__all__ = ["read_table", "jdbc_ready", "write_table"]
