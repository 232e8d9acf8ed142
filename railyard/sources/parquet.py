"""Parquet landing, staging and warehouse tables (A1, A5, A7, A10, A11,
A13, A14) and versioned dimension tables.

Paths are plain Hadoop file-system URIs (``s3a://``, ``hdfs://``, ``file:``):
object-store credentials come from the session configuration, never from
this module.

Layout:
    {raw}/dt=YYYY-MM-DD/{entity}.parquet                 landing (A1, A10)
    {wh}/staging/{entity}/load_dt=YYYY-MM-DD/            staging (A11)
    {wh}/dim/{name}/v={version}/ + {wh}/dim/{name}/_current   dimensions
    {wh}/fact/{name}/{date_col}=YYYY-MM-DD/              facts (A13)
    {wh}/mart/route_hourly/dt=YYYY-MM-DD/                mart (A5, A14)
"""

from __future__ import annotations

import time
from contextlib import ExitStack, contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.conform import conform
from railyard.schemas import empty
from railyard.sources.dim_store import DimStore


def raw_path(base: str, date_str: str, name: str) -> str:
    return f"{base.rstrip('/')}/dt={date_str}/{name}.parquet"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system of ``path``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_raw(
    spark: SparkSession,
    base: str,
    date_str: str,
    name: str,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A1: one entity of one landing partition, conformed when a schema is
    given. A file written by pandas and a folder written by Spark read the
    same way: nanosecond timestamps (which Spark refuses by default) are read
    as epoch nanoseconds and conformed to microsecond timestamps."""
    if spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", "false") != "true":
        # Only changes columns that would otherwise fail to read.
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(raw_path(base, date_str, name))
    return conform(df, schema, epoch_unit="ns") if schema is not None else df


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` conformed to ``schema``, or an empty table
    when nothing has been written there yet. Any other read error (a corrupt
    file, missing permissions) propagates instead of being taken for "empty".
    """
    if not path_exists(spark, path):
        return empty(spark, schema)
    return conform(spark.read.parquet(path), schema)


def write_raw(df: DataFrame, base: str, date_str: str, name: str) -> bool:
    """A10: land one entity for one date; an empty set writes nothing.

    Returns whether anything was written. Overwrite makes a re-landing of
    the same date replace its earlier copy.
    """
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(raw_path(base, date_str, name))
    return True


def write_staging(df: DataFrame, warehouse: str, name: str, load_date: str) -> str:
    """Overwrite this load's own staging partition, so a rerun of the
    same batch replaces it and other loads are untouched."""
    path = f"{warehouse.rstrip('/')}/staging/{name}/load_dt={load_date}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_col: str,
    sort_cols: list[str],
    *,
    mode: str = "overwrite",
    num_partitions: int | None = None,
    whole: bool = False,
) -> None:
    """Write ``df`` partitioned by ``partition_col`` and sorted
    by ``sort_cols`` inside every file.

    Rows are range-partitioned on (partition column, sort columns): a busy
    date is split across several tasks instead of landing in one, every task
    writes a contiguous key range (few files per date), and sorted row
    groups let readers skip by min/max statistics. With ``mode="overwrite"``
    and the session's dynamic partition overwrite only the dates present in
    ``df`` are replaced; with ``whole`` the folder as a whole is. Left to
    itself (no ``num_partitions``) AQE merges neighbouring small ranges.
    """
    ranges = [num_partitions] if num_partitions else []
    (
        df.repartitionByRange(*ranges, partition_col, *sort_cols)
        .sortWithinPartitions(partition_col, *sort_cols)
        .write.mode(mode)
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def write_clustered(
    df: DataFrame,
    path: str,
    partition_col: str,
    sort_cols: list[str],
    *,
    mode: str = "append",
    whole: bool = False,
) -> None:
    """Write ``df`` partitioned by ``partition_col``, each file sorted.

    Rows are rebalanced on the partition column: AQE splits a busy date over
    several tasks and puts sparse ones together, by the bytes it measured. One
    shuffle, and ``df`` is computed once (range bounds would compute it twice).
    ``overwrite`` replaces the partitions that ``df`` has rows for, with
    ``whole`` all there are. A file costs more than its few rows when dates are
    many and sparse, so even a small batch is dealt to all cores.
    """
    with setting(df.sparkSession, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k"):
        (
            df.hint("rebalance", partition_col)
            .sortWithinPartitions(partition_col, *sort_cols)
            .write.mode(mode)
            .option("partitionOverwriteMode", "static" if whole else "dynamic")
            .partitionBy(partition_col)
            .parquet(path)
        )


#: Settings that are held now: how many writes hold each, and what it was before.
_HELD: dict[str, list] = {}
_HOLDING = Lock()


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the time of one write; of several writes at once,
    the last one to end puts back what was there before the first."""
    with _HOLDING:
        if name not in _HELD:
            _HELD[name] = [0, spark.conf.get(name, None)]
            spark.conf.set(name, value)
        _HELD[name][0] += 1
    try:
        yield
    finally:
        with _HOLDING:
            held = _HELD[name]
            held[0] -= 1
            if not held[0]:
                del _HELD[name]
                if held[1] is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, held[1])


_SHUFFLE_FILES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CODEC = "spark.sql.parquet.compression.codec"
_SPLIT = "spark.sql.files.maxPartitionBytes"
#: Settings for :func:`sparing_disk`, where the session has left Spark's default:
#: name, that default, value.
_SPARING = (
    (_CODEC, ("snappy",), "zstd"),
    # A byte of these files holds more rows: smaller tasks, or their sorts spill.
    (_SPLIT, ("134217728b", "134217728", "128m", "128MB"), "48m"),
)


@contextmanager
def sparing_disk(spark: SparkSession):
    """For runs of many steps: the shuffle files of each go when it ends (else
    they stay until the driver happens to collect its garbage), and files are
    written with zstd and read in smaller splits, unless the session has its own
    codec or split size."""
    with ExitStack() as held:
        held.enter_context(setting(spark, _SHUFFLE_FILES, "true"))
        for name, default, value in _SPARING:
            if spark.conf.get(name, default[0]) in default:
                held.enter_context(setting(spark, name, value))
        yield


def drop_partitions(spark: SparkSession, path: str, partition_col: str, values) -> None:
    """Remove the named partition folders, where there are any."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for value in values:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_col}={value}")
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)


def read_partition_range(
    spark: SparkSession,
    path: str,
    partition_col: str,
    ts_col: str,
    lo: str,
    hi: str,
) -> DataFrame:
    """A3 on a date-partitioned table: ``[lo, hi)`` on the timestamp plus
    the implied date range on the partition column, so partition pruning
    skips whole folders (Spark does not derive one from the other)."""
    lo_ts = F.lit(lo).cast(T.TimestampType())
    hi_ts = F.lit(hi).cast(T.TimestampType())
    return spark.read.parquet(path).filter(
        (F.col(partition_col) >= F.to_date(lo_ts))
        & (F.col(partition_col) <= F.to_date(hi_ts))
        & (F.col(ts_col) >= lo_ts)
        & (F.col(ts_col) < hi_ts)
    )


# --- versioned tables (dimensions) ----------------------------------------------

def _pointer(base: str) -> str:
    return f"{base.rstrip('/')}/_current"


def current_version(spark: SparkSession, base: str) -> str | None:
    """Name of the version the table's pointer (or manifest of segments) designates, if any."""
    store = DimStore(spark, base)
    if store.exists():
        return store.version()
    if not path_exists(spark, _pointer(base)):
        return None
    marks = spark.read.schema("seq long, version string").json(_pointer(base))
    row = marks.agg(F.max_by("version", F.coalesce("seq", F.lit(0))).alias("version")).first()
    return row["version"]


def read_current(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The current version of a versioned table, all segments of a segmented
    one, or None before the first write."""
    store = DimStore(spark, base)
    if store.exists():
        df = store.read()
        return conform(df, schema) if schema is not None else df
    version = current_version(spark, base)
    if version is None:
        return None
    df = spark.read.parquet(f"{base.rstrip('/')}/v={version}")
    return conform(df, schema) if schema is not None else df


def write_version(df: DataFrame, base: str, version: str) -> str:
    """Write ``df`` as a new version, then switch the pointer to it.

    A dimension is rebuilt from its previous version, which Parquet cannot
    overwrite while reading; writing a new folder and switching a one-row
    pointer afterwards means readers see either the old or the new version,
    never a partial one. Old versions stay for audit and time travel.
    """
    target = f"{base.rstrip('/')}/v={version}"
    df.write.mode("overwrite").parquet(target)
    write_version_pointer(df.sparkSession, base, version)
    return target


def write_version_pointer(spark: SparkSession, base: str, version: str) -> None:
    """Switch a versioned table to an already written ``version``.

    A switch is a new file and the latest counts: no moment without a pointer.
    """
    spark.createDataFrame([(time.time_ns(), version)], "seq long, version string").coalesce(1).write.mode(
        "append"
    ).json(_pointer(base))


__all__ = [
    "raw_path",
    "path_exists",
    "read_raw",
    "read_or_empty",
    "write_raw",
    "write_staging",
    "write_partitioned",
    "write_clustered",
    "setting",
    "sparing_disk",
    "drop_partitions",
    "read_partition_range",
    "current_version",
    "read_current",
    "write_version",
    "write_version_pointer",
]
