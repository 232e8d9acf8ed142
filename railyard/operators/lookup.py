"""Dimension lookups and key-based set operators.

All lookups are left equi-joins on the business key, so Spark plans a hash
(broadcast) or sort-merge join; the as-of variant adds a residual range
condition on top of the equi-key, never a cross product. The choice is
Catalyst's and AQE's, by size in bytes: no hint, no counting beforehand. A hot
key on the fact side is handled by AQE's skew-join split when the dimension is
not broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_D = "_ry_d_"


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _and(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols)


def current_rows(dim: DataFrame, is_current: str = "is_current") -> DataFrame:
    """Current versions only (C1); a table without the flag is all current."""
    return dim.filter(F.col(is_current)) if is_current in dim.columns else dim


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    key,
    sk: str,
    *,
    fact_key=None,
    sk_as: str | None = None,
    attrs: tuple[str, ...] | list[str] = (),
    mode: str = "current",
    ts: str | None = None,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    is_current: str = "is_current",
    first_open: bool = True,
) -> DataFrame:
    """Attach a dimension's surrogate (and chosen attributes) to each fact row.

    ``mode="current"`` (D1, what the batch job does): match the current
    version of the key. ``mode="as_of"`` (D8, historical coherence): match the
    version whose half-open ``[valid_from, valid_to)`` holds the fact's
    ``ts``; with ``first_open`` the first version of a key also covers
    everything before it, so facts older than the first load still resolve.

    ``fact_key`` names the fact columns when they differ from the dimension's
    (D2: ``payment_method`` vs ``code``). Unmatched facts keep a null key;
    the fact row count never changes as long as the dimension has one
    matching version per key (checked by ``scd.validity_report``).
    """
    keys = _as_list(key)
    fkeys = _as_list(fact_key) if fact_key is not None else keys
    out_sk = sk_as or sk
    d_keys = [f"{_D}{k}" for k in keys]

    if mode == "current":
        d = current_rows(dim, is_current).select(
            *[F.col(k).alias(dk) for k, dk in zip(keys, d_keys)],
            F.col(sk).alias(out_sk),
            *[F.col(a) for a in attrs],
        )
        cond = _and([facts[fk] == d[dk] for fk, dk in zip(fkeys, d_keys)])
        return facts.join(d, cond, "left").drop(*d_keys)

    if mode != "as_of":
        raise ValueError(f"unknown lookup mode {mode!r}")
    if ts is None:
        raise ValueError("as_of lookup needs the fact's event-time column")
    vf, vt = f"{_D}vf", f"{_D}vt"
    d = dim.select(
        *[F.col(k).alias(dk) for k, dk in zip(keys, d_keys)],
        F.col(sk).alias(out_sk),
        F.col(valid_from).alias(vf),
        F.col(valid_to).alias(vt),
        *[F.col(a) for a in attrs],
    )
    if first_open:
        # Each key's first start, by a grouped min (combined map-side) joined
        # back on the key: no key's versions are sorted together in one task.
        first = d.groupBy(*d_keys).agg(F.min(vf).alias(f"{_D}first"))
        d = (
            d.join(first, d_keys)
            .withColumn(vf, F.when(F.col(vf) == F.col(f"{_D}first"), F.lit(None)).otherwise(F.col(vf)))
            .drop(f"{_D}first")
        )
    t = facts[ts]
    cond = _and(
        [facts[fk] == d[dk] for fk, dk in zip(fkeys, d_keys)]
        + [d[vf].isNull() | (t >= d[vf]), d[vt].isNull() | (t < d[vt])]
    )
    return facts.join(d, cond, "left").drop(*d_keys, vf, vt)


def orphans(facts: DataFrame, dim: DataFrame, fact_key, key=None) -> DataFrame:
    """Fact rows whose non-null foreign key has no dimension row."""
    fkeys = _as_list(fact_key)
    keys = _as_list(key) if key is not None else fkeys
    d_keys = [f"{_D}{k}" for k in keys]
    d = dim.select(*[F.col(k).alias(dk) for k, dk in zip(keys, d_keys)])
    present = _and([F.col(fk).isNotNull() for fk in fkeys])
    cond = _and([facts[fk] == d[dk] for fk, dk in zip(fkeys, d_keys)])
    return facts.filter(present).join(d, cond, "left_anti")


def members(facts: DataFrame, keys: DataFrame, key, fact_key=None) -> DataFrame:
    """C4: rows of ``facts`` whose key is in the set ``keys`` -- a left-semi
    join, so the set is never collected to the driver however large."""
    fkeys = _as_list(fact_key) if fact_key is not None else _as_list(key)
    ks = _as_list(key)
    d_keys = [f"{_D}{k}" for k in ks]
    d = keys.select(*[F.col(k).alias(dk) for k, dk in zip(ks, d_keys)])
    cond = _and([facts[fk] == d[dk] for fk, dk in zip(fkeys, d_keys)])
    return facts.join(d, cond, "left_semi")


def absent_rows(incoming: DataFrame, existing: DataFrame, key) -> DataFrame:
    """Incoming rows whose key is not in ``existing`` (D10: insert-if-absent).

    The key is unique over the whole target, so the anti-join is on it alone,
    whatever the rows' dates; it reads only that column of the history. A null
    equals a null, so a row without a key is not inserted again by a rerun.
    """
    keys = _as_list(key)
    d_keys = [f"{_D}{k}" for k in keys]
    target = existing.select(*[F.col(k).alias(dk) for k, dk in zip(keys, d_keys)])
    same = _and([F.col(k).eqNullSafe(F.col(dk)) for k, dk in zip(keys, d_keys)])
    return incoming.join(target, same, "left_anti")


__all__ = [
    "current_rows",
    "lookup",
    "orphans",
    "members",
    "absent_rows",
]
