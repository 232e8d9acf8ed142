"""Slowly changing dimensions: SCD2 merge (J1), SCD1 upsert (J3), inferred
members (J7) and the SCD2 validity report (F3).

SCD2 semantics, in one join of the *current* rows with the batch (history
passes through untouched, so its size never enters the join). Each joined row
gives the version it keeps, closes or corrects and the version it opens, as an
exploded pair; the pairs are written once and read by all that follows:

* compare null-safely on ``compare_cols``;
* key only in the batch, or only closed versions so far: new version;
* changed: the current version is closed at ``as_of`` (``valid_to = as_of``,
  ``is_current = false``) and a new one opens at the same ``as_of``, so the
  intervals are half-open ``[valid_from, valid_to)`` with neither gap nor
  overlap;
* changed, but the current version itself opened at ``as_of`` (the same date
  loaded again with a correction): that version takes the new attributes and
  keeps its surrogate and interval;
* unchanged, or absent from the batch: untouched;
* existing surrogates never change; new versions continue the key sequence
  (K1). Feeding the same batch twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.functions.exprs import changed_any, ts_literal
from railyard.operators.keys import assign_surrogates, max_key
from railyard.schemas import empty
from railyard.session import written

CHANGE = "_change"


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def empty_versions(
    incoming: DataFrame,
    sk: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    is_current: str = "is_current",
    extra: dict[str, T.DataType] | None = None,
) -> DataFrame:
    """An empty SCD2 table shaped after ``incoming`` (first load)."""
    fields = [T.StructField(sk, T.LongType())] + list(incoming.schema.fields)
    for name, dtype in (extra or {}).items():
        fields.append(T.StructField(name, dtype))
    fields += [
        T.StructField(valid_from, T.TimestampType()),
        T.StructField(valid_to, T.TimestampType()),
        T.StructField(is_current, T.BooleanType()),
    ]
    return empty(incoming.sparkSession, T.StructType(fields))


def scd2_first_load(
    incoming: DataFrame,
    key,
    as_of,
    *,
    sk: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    is_current: str = "is_current",
    new_defaults: dict[str, Column] | None = None,
    with_change: bool = False,
) -> DataFrame:
    """The dimension after its first batch: every row is a version that opens
    at ``as_of``. What :func:`scd2_merge` gives on an empty table, without the
    join and its written pairs."""
    keyed = assign_surrogates(incoming, _as_list(key), sk)
    return keyed.select(
        sk,
        *incoming.columns,
        *[value.alias(name) for name, value in (new_defaults or {}).items()],
        ts_literal(as_of).alias(valid_from),
        F.lit(None).cast(T.TimestampType()).alias(valid_to),
        F.lit(True).alias(is_current),
        *([F.lit("new").alias(CHANGE)] if with_change else []),
    )


def scd2_merge(
    current: DataFrame,
    incoming: DataFrame,
    key,
    compare_cols: list[str],
    as_of,
    *,
    sk: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    is_current: str = "is_current",
    new_defaults: dict[str, Column] | None = None,
    with_change: bool = False,
) -> DataFrame:
    """Return the whole dimension after applying ``incoming`` at ``as_of``.

    ``current`` holds every version (may be empty, see :func:`empty_versions`);
    ``incoming`` one row per key (deduplicate first). Columns of the result
    are those of ``current``; attributes of new versions come from
    ``incoming``, and ``new_defaults`` fills columns the batch lacks (e.g.
    ``active_flag``). With ``with_change`` a ``_change`` column tells
    ``history | unchanged | closed | corrected | new`` apart.
    """
    keys = _as_list(key)
    cols = current.columns
    history = current.filter(~F.col(is_current)).withColumn(CHANGE, F.lit("history"))
    live = current.filter(F.col(is_current))
    pairs = written(
        _pairs(live, incoming, keys, compare_cols, as_of, "full_outer", sk, valid_from, valid_to, is_current, new_defaults),
        "versions",
    )
    fresh = assign_surrogates(
        pairs.filter(F.col(CHANGE) == "new").drop(sk), keys, sk, base=max_key(current, sk)
    )
    out = (
        history.select(*cols, CHANGE)
        .unionByName(pairs.filter(F.col(CHANGE) != "new"))
        .unionByName(fresh.select(*cols, CHANGE))
    )
    return out if with_change else out.drop(CHANGE)


def scd2_changes(
    live: DataFrame,
    incoming: DataFrame,
    key,
    compare_cols: list[str],
    as_of,
    *,
    sk: str,
    base: int = 0,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    is_current: str = "is_current",
    new_defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """Only the versions that ``incoming`` closes, corrects or opens, told
    apart by ``_change``; new ones are numbered after ``base``.

    ``live`` are the current versions. Keys that the batch lacks never enter
    the join, and what is written follows the changes, not the dimension.
    """
    keys = _as_list(key)
    pairs = _pairs(live, incoming, keys, compare_cols, as_of, "right", sk, valid_from, valid_to, is_current, new_defaults)
    seen = Observation()
    opened = F.count(F.when(F.col(CHANGE) == "new", 1)).alias("opened")
    pairs = written(pairs.filter(F.col(CHANGE) != "unchanged").observe(seen, opened), "changes")
    if not seen.get["opened"]:
        return pairs
    fresh = assign_surrogates(pairs.filter(F.col(CHANGE) == "new").drop(sk), keys, sk, base=base)
    return pairs.filter(F.col(CHANGE) != "new").unionByName(fresh.select(*pairs.columns))


def _pairs(
    live: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    compare_cols: list[str],
    as_of,
    how: str,
    sk: str,
    valid_from: str,
    valid_to: str,
    is_current: str,
    new_defaults: dict[str, Column] | None,
) -> DataFrame:
    """The version every joined key keeps, closes or corrects and the one it
    opens, in the columns of ``live`` and ``_change``."""
    at = ts_literal(as_of)
    cols = live.columns
    types = {f.name: f.dataType for f in live.schema.fields}
    defaults = dict(new_defaults or {})
    batch_cols = set(incoming.columns) - set(keys)
    # Key columns are merged by the USING join, so presence on each side is
    # read from a non-key column: the surrogate (never null in a dimension)
    # and a marker every incoming row carries.
    joined = live.alias("c").join(incoming.withColumn("_ry_in", F.lit(True)).alias("i"), keys, how)
    in_c = F.col(f"c.{sk}").isNotNull()
    in_i = F.col("i._ry_in").isNotNull()
    changed = in_c & in_i & changed_any("c", "i", compare_cols)
    reopened = F.col(f"c.{valid_from}").eqNullSafe(at)
    corrected, closed = changed & reopened, changed & ~reopened

    def before(c: str) -> Column:
        """The version the key already has: kept, corrected or closed."""
        if c in keys:
            return F.col(c)
        if c == valid_to:
            return F.when(closed, at).otherwise(F.col(f"c.{c}"))
        if c == is_current:
            return ~closed
        if c in batch_cols:
            return F.when(corrected, F.col(f"i.{c}")).otherwise(F.col(f"c.{c}"))
        return F.col(f"c.{c}")

    def opened(c: str) -> Column:
        """The version that starts at ``as_of``; its surrogate comes later."""
        if c in keys:
            return F.col(c)
        if c == valid_from:
            return at
        if c == is_current:
            return F.lit(True)
        if c in (sk, valid_to):
            return F.lit(None)
        return F.col(f"i.{c}") if c in batch_cols else defaults.get(c, F.lit(None))

    def version(value, change: Column) -> Column:
        return F.struct(*[value(c).cast(types[c]).alias(c) for c in cols], change.alias(CHANGE))

    state = (
        F.when(closed, F.lit("closed")).when(corrected, F.lit("corrected")).otherwise(F.lit("unchanged"))
    )
    pair = F.array(
        F.when(in_c, version(before, state)),
        F.when(in_i & (~in_c | closed), version(opened, F.lit("new"))),
    )
    return joined.select(F.inline(F.array_compact(pair)))


def scd1_upsert(
    current: DataFrame,
    incoming: DataFrame,
    key,
    *,
    sk: str,
) -> DataFrame:
    """Type-1 dimension upsert: the batch overwrites attributes in place.

    Existing keys keep their surrogate; keys only in ``current`` stay as
    they are; new keys get the next surrogates. Built from a left join, a
    left-anti join and a union: no full scan of the result is repeated.
    """
    keys = _as_list(key)
    cols = current.columns
    cur_types = {f.name: f.dataType for f in current.schema.fields}
    # Attributes the batch does not carry keep their current value.
    kept_cols = [c for c in cols if c not in incoming.columns and c != sk and c not in keys]
    with_sk = incoming.join(current.select(*keys, sk, *kept_cols), keys, "left")
    updated = with_sk.filter(F.col(sk).isNotNull())
    fresh = assign_surrogates(
        with_sk.filter(F.col(sk).isNull()).drop(sk, *kept_cols), keys, sk, base=max_key(current, sk)
    )
    untouched = current.join(incoming.select(*keys), keys, "left_anti")

    def typed(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(
            *[(F.col(c) if c in have else F.lit(None)).cast(cur_types[c]).alias(c) for c in cols]
        )

    return typed(untouched).unionByName(typed(updated)).unionByName(typed(fresh))


def scd1_changes(current: DataFrame, incoming: DataFrame, key, *, sk: str, base: int = 0) -> DataFrame:
    """Only the rows that :func:`scd1_upsert` would change or add."""
    keys = _as_list(key)
    cols = current.columns
    attrs = [c for c in cols if c in incoming.columns and c not in keys]
    joined = current.alias("c").join(incoming.withColumn("_ry_in", F.lit(True)).alias("i"), keys, "right")
    known = F.col(f"c.{sk}").isNotNull()
    types = {f.name: f.dataType for f in current.schema.fields}
    row = [
        (F.col(c) if c in keys else F.col(f"i.{c}") if c in attrs else F.col(f"c.{c}")).cast(types[c]).alias(c)
        for c in cols
    ]
    seen = Observation()
    rows = joined.where(~known | changed_any("c", "i", attrs)).select(*row)
    rows = written(rows.observe(seen, F.count(F.when(F.col(sk).isNull(), 1)).alias("added")), "changes")
    if not seen.get["added"]:
        return rows
    fresh = assign_surrogates(rows.filter(F.col(sk).isNull()).drop(sk), keys, sk, base=base)
    return rows.filter(F.col(sk).isNotNull()).unionByName(fresh.select(*cols))


def infer_members(
    dim: DataFrame,
    referenced: DataFrame,
    key: str,
    *,
    sk: str,
) -> DataFrame:
    """Add placeholder members for keys facts reference but the dimension
    lacks (J7): attributes null, surrogate continuing the sequence.

    ``referenced`` is a one-column frame of referenced keys (duplicates ok).
    Returns the whole dimension.
    """
    missing = (
        referenced.select(F.col(referenced.columns[0]).alias(key))
        .filter(F.col(key).isNotNull())
        .distinct()
        .join(dim.select(key), key, "left_anti")
    )
    keyed = assign_surrogates(missing, [key], sk, base=max_key(dim, sk))
    dim_types = [(f.name, f.dataType) for f in dim.schema.fields]
    have = set(keyed.columns)
    return dim.unionByName(
        keyed.select(*[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in dim_types])
    )


def validity_report(
    dim: DataFrame,
    key,
    *,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    is_current: str = "is_current",
) -> DataFrame:
    """count SCD2 invariant violations, one row per rule.

    Rules (counted in rows, except the two per-key rules, counted in keys):

    * ``empty_interval``: ``valid_to <= valid_from``;
    * ``flag_mismatch``: ``is_current`` disagrees with an open ``valid_to``;
    * ``duplicate_start`` / ``duplicate_end``: two versions of a key start
      (or end) at the same instant;
    * ``dangling_end``: a closed version ends where no version of its key
      starts (a gap);
    * ``open_count``: keys without exactly one open version;
    * ``open_not_latest``: keys whose open version is not the latest start.

    Together these force each version to end exactly where the next begins.
    Every check is a grouped aggregate or an equi-join on (key, instant), so
    no key's versions are ever sorted in one task, whatever their number.
    """
    keys = _as_list(key)
    d = dim.select(
        *keys,
        F.col(valid_from).alias("_vf"),
        F.col(valid_to).alias("_vt"),
        F.col(is_current).alias("_cur"),
    )

    def total(df: DataFrame, name: str, expr) -> DataFrame:
        return df.agg(F.coalesce(F.sum(expr), F.lit(0)).cast("long").alias("violations")).select(
            F.lit(name).alias("rule"), "violations"
        )

    open_ = F.col("_vt").isNull()
    rows = d.agg(
        F.coalesce(F.sum(F.when(~open_ & (F.col("_vt") <= F.col("_vf")), 1)), F.lit(0))
        .cast("long").alias("empty_interval"),
        F.coalesce(F.sum(F.when(open_ != F.coalesce(F.col("_cur"), F.lit(False)), 1)), F.lit(0))
        .cast("long").alias("flag_mismatch"),
    ).unpivot([], ["empty_interval", "flag_mismatch"], "rule", "violations")
    starts = d.groupBy(*keys, "_vf").agg(F.count(F.lit(1)).alias("n"))
    ends = d.filter(~open_).groupBy(*keys, "_vt").agg(F.count(F.lit(1)).alias("n"))
    closed_ends = d.filter(~open_).select(*keys, F.col("_vt").alias("_t"))
    start_points = d.select(*keys, F.col("_vf").alias("_t"))
    dangling = closed_ends.join(start_points, [*keys, "_t"], "left_anti")
    per_key = d.groupBy(*keys).agg(
        F.sum(open_.cast("int")).alias("opens"),
        F.max("_vf").alias("latest"),
        F.max(F.when(open_, F.col("_vf"))).alias("open_start"),
    )
    parts = [
        rows,
        total(starts, "duplicate_start", F.when(F.col("n") > 1, F.col("n"))),
        total(ends, "duplicate_end", F.when(F.col("n") > 1, F.col("n"))),
        total(dangling, "dangling_end", F.lit(1)),
        total(per_key, "open_count", F.when(F.col("opens") != 1, 1)),
        total(
            per_key,
            "open_not_latest",
            F.when((F.col("opens") >= 1) & ~F.col("open_start").eqNullSafe(F.col("latest")), 1),
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


__all__ = [
    "CHANGE",
    "empty_versions",
    "scd2_first_load",
    "scd2_merge",
    "scd2_changes",
    "scd1_upsert",
    "scd1_changes",
    "infer_members",
    "validity_report",
]
