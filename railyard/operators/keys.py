"""Surrogate key assignment (K1).

The warehouse DDL uses sequence-backed keys. On Spark the equivalent is a
dense numbering in the order of a unique key, one way for every size and
without ever moving all rows into one task (a global window would):

* the rows are range-partitioned by the order columns, sorted within their
  partitions and written once as Parquet into the shared checkpoint folder,
  each with its partition and its position there (the low 33 bits of
  ``monotonically_increasing_id``). Range bounds depend on partitioning, the
  written file does not: a lost executor re-reads it and gets the same keys;
* rows are counted per partition -- one number each, so what reaches the
  driver is bounded by the partition count, never by the data;
* every row gets ``base + offset[partition] + position + 1``. The offsets are
  one array value of a scalar subquery, indexed by partition, so the result
  stays a plain projection of a Parquet scan whose size Catalyst knows.

Left to itself (no ``num_partitions``) AQE merges neighbouring small ranges,
so a dimension of a few rows is one small file.

Number the staged batch, or only its key, and attach lookups afterwards: the
rows are then written once, as narrow as they come, and the lookups run once,
as a projection of what was written.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.session import written

_PID, _POS = "_ry_pid", "_ry_pos"
_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | row number


def max_key(dim: DataFrame, sk: str) -> Column:
    """Current highest key of a table as a scalar subquery (0 when empty)."""
    return dim.select(F.coalesce(F.max(sk), F.lit(0)).cast("long")).scalar()


def assign_surrogates(
    df: DataFrame,
    order_by: list[str],
    sk: str,
    base: Column | int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``sk`` = base+1 .. base+n, dense, in ``order_by`` order.

    ``order_by`` must be a unique key of ``df``. ``base`` is usually
    :func:`max_key` of the existing table, so new members continue its
    sequence.
    """
    spark = df.sparkSession
    base_col = base if isinstance(base, Column) else F.lit(int(base))
    ranges = [num_partitions, *order_by] if num_partitions else order_by
    tagged = written(
        df.repartitionByRange(*ranges)
        .sortWithinPartitions(*order_by)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id().bitwiseAND((1 << _POS_BITS) - 1)),
        "numbered",
    )
    counts = dict(tagged.groupBy(_PID).count().collect())
    sizes = [int(counts.get(p, 0)) for p in range(max(counts, default=0) + 1)]
    offsets = spark.createDataFrame([([0, *accumulate(sizes)],)], "offsets array<long>").scalar()
    return tagged.withColumn(
        sk, (base_col + F.element_at(offsets, F.col(_PID) + 1) + F.col(_POS) + F.lit(1)).cast("long")
    ).drop(_PID, _POS)


__all__ = ["assign_surrogates", "max_key"]
