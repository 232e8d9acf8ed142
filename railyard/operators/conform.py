"""Typing, audit stamp and deduplication (B1, B2, F1).

``conform`` gives every raw batch its declared schema whatever the writer
inferred (all-null columns typed as int, ``timestamp_ntz``, JSON text for a
struct). ``dedupe_latest`` keeps one row per business key with a total
order, as a grouped aggregate so a hot key is combined map-side instead of
being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.functions.exprs import audit

REJECT = "_conform_errors"


_EPOCH = {
    # Exact: a double would lose the last microsecond of some instants.
    "ns": lambda c: F.timestamp_micros(F.floor(c.cast("decimal(20,0)") / F.lit(1000)).cast("long")),
    "us": lambda c: F.timestamp_micros(c.cast("long")),
    "ms": lambda c: F.timestamp_millis(c.cast("long")),
    "s": lambda c: F.timestamp_seconds(c.cast("long")),
}


def _convert(
    src: T.DataType | None, name: str, target: T.DataType, safe: bool, epoch_unit: str = "s"
) -> Column:
    if src is None:
        return F.lit(None).cast(target)
    c = F.col(f"`{name}`")
    if isinstance(target, (T.StructType, T.ArrayType)) and isinstance(src, T.StringType):
        return F.from_json(c, target)
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)) and isinstance(src, T.IntegralType):
        # An integer in a timestamp column is an epoch count (pandas writes
        # nanoseconds); an all-null column is inferred as int and stays null.
        return _EPOCH[epoch_unit](c).cast(target)
    if src == target:
        return c
    return c.try_cast(target) if safe else c.cast(target)


def _broken_json(c: Column, target: T.DataType) -> Column:
    """JSON text that does not parse as ``target``: a struct of nulls else."""
    if not isinstance(target, T.StructType):
        return F.lit(False)
    bad = "_broken"
    schema = T.StructType([*target.fields, T.StructField(bad, T.StringType())])
    return F.from_json(c, schema, {"columnNameOfCorruptRecord": bad})[bad].isNotNull()


def conform(
    df: DataFrame,
    schema: T.StructType,
    *,
    safe: bool = False,
    keep_extra: tuple[str, ...] = (),
    epoch_unit: str = "s",
) -> DataFrame:
    """B1: select exactly ``schema``'s columns in its order and types.

    Missing columns become typed nulls, extra columns are dropped (except
    ``keep_extra``). JSON text becomes the declared struct. With ``safe``,
    values that do not cast become null and ``_conform_errors`` lists the
    columns where a non-null input was lost, so the caller can route those
    rows to quarantine instead of failing the batch. Integers declared as
    timestamps are epoch counts in ``epoch_unit`` (``ns``, ``us``, ``ms``,
    ``s``).
    """
    src = {f.name: f.dataType for f in df.schema.fields}
    cols = [
        _convert(src.get(f.name), f.name, f.dataType, safe, epoch_unit).alias(f.name)
        for f in schema.fields
    ]
    extra = [F.col(f"`{c}`") for c in keep_extra if c in src and c not in schema.names]
    if not safe:
        return df.select(*cols, *extra)
    lost = [
        F.when(
            F.col(f"`{f.name}`").isNotNull()
            & (
                _convert(src[f.name], f.name, f.dataType, True, epoch_unit).isNull()
                | (
                    _broken_json(F.col(f"`{f.name}`"), f.dataType)
                    if isinstance(src[f.name], T.StringType)
                    else F.lit(False)
                )
            ),
            F.lit(f.name),
        )
        for f in schema.fields
        if f.name in src and src[f.name] != f.dataType
    ]
    errors = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    return df.select(*cols, *extra, errors.alias(REJECT))


def stamp(df: DataFrame, load_id: str, ts=None, ts_name: str = "ingestion_ts") -> DataFrame:
    """B2: add ``load_id`` and the ingestion instant (a literal for reruns)."""
    return df.withColumns(audit(load_id, ts, ts_name))


def dedupe_latest(
    df: DataFrame,
    key,
    order_by: list[str] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """one row per ``key``: the greatest by ``order_by``, then by every
    other column (a total order, so reruns pick the same row).

    Computed as ``max(struct(order..., rest...))`` per key: a grouped
    aggregate with partial aggregation, so even a key holding a third of the
    rows is reduced to one row per map task before the shuffle. Nulls sort
    lowest, i.e. a non-null ``order_by`` value wins. ``copies`` names a column
    for the number of rows each key had.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order_by or [])
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(f"`{c}`") for c in order + rest])
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    return (
        df.groupBy(*keys)
        .agg(F.max(packed).alias("_ry_best"), *counted)
        .select(*keys, *[F.col(f"_ry_best.`{c}`").alias(c) for c in order + rest], *([copies] if copies else []))
        .select(*df.columns, *([copies] if copies else []))
    )


__all__ = ["REJECT", "conform", "stamp", "dedupe_latest"]
