"""Column expressions shared by the operators (I1-I14 of the inventory).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value) -> Column:
    """A timestamp literal; ``None`` means the job's current timestamp.

    Passing a literal keeps reruns reproducible (every row of one batch
    shares one instant), which SCD2 and audit stamps rely on.
    """
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast(T.TimestampType())


def typed_null(dtype: T.DataType | str) -> Column:
    """A null of a declared type (B9); an untyped null is ``void``."""
    return F.lit(None).cast(dtype)


def changed_any(left: str, right: str, cols: list[str]) -> Column:
    """True when any compared column differs, nulls included.

    ``a <=> b`` is null-safe, so a value becoming or leaving null counts as a
    change; structs and arrays compare element-wise.
    """
    diffs = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    return reduce(or_, diffs) if diffs else F.lit(False)


def exact_avg(c: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Average whose value does not depend on summation order.

    Decimals (and integers) are summed exactly and divided once as doubles,
    so the same input gives bit-identical results on any partitioning.
    ``dtype`` is the decimal type to sum in (e.g. the column's own type).
    """
    col = _c(c)
    total = F.sum(col.cast(dtype)) if dtype is not None else F.sum(col)
    return total.cast(T.DoubleType()) / F.count(col)


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole seconds from start to end."""
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))).cast(T.IntegerType())


def date_key(ts: ColumnOrName) -> Column:
    """Calendar key ``yyyyMMdd`` as int (I8)."""
    return F.date_format(_c(ts), "yyyyMMdd").cast(T.IntegerType())


def time_key(ts: ColumnOrName) -> Column:
    """Second-of-day key, 0..86399."""
    t = _c(ts)
    return (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast(T.IntegerType())


def hour_bucket(ts: ColumnOrName) -> Column:
    """Start of the hour."""
    return F.date_trunc("hour", _c(ts))


def in_range(ts: ColumnOrName, lo, hi) -> Column:
    """Half-open ``[lo, hi)`` on a timestamp column (C3); pushed to the scan."""
    t = _c(ts)
    return (t >= ts_literal(lo)) & (t < ts_literal(hi))


def audit(load_id: str, ts=None, ts_name: str = "ingestion_ts") -> dict[str, Column]:
    """Audit stamp columns (B2): ``load_id`` and an ingestion instant."""
    return {"load_id": F.lit(load_id), ts_name: ts_literal(ts)}


def batch_load_id(date_str: str) -> str:
    return f"batch_{date_str}"


def json_field(c: ColumnOrName, path: str) -> Column:
    """One field of a JSON text column (I14), as text."""
    return F.get_json_object(_c(c), path)


def parse_json(c: ColumnOrName, schema: T.DataType | str) -> Column:
    """JSON text to a typed struct."""
    return F.from_json(_c(c), schema)


__all__ = [
    "json_field",
    "parse_json",
    "ts_literal",
    "typed_null",
    "changed_any",
    "exact_avg",
    "seconds_between",
    "date_key",
    "time_key",
    "hour_bucket",
    "in_range",
    "audit",
    "batch_load_id",
]
