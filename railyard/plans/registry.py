"""Registered queries over TESTDATA: one per inventory operator.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads the given tables
through the role mapping in ``fixtures``; all run over whole tables. Results
pass through :func:`comparable`, which only changes representation (decimals
to double, timestamps to ``timestamp_ntz``) so the DuckDB oracle can compare
them value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.plans import fixtures as fx
from railyard.plans.memo import _MEMO, per_query
from railyard.session import prepare_session

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

def comparable(df: DataFrame) -> DataFrame:
    """Decimals as double, zoned timestamps as wall-clock ``timestamp_ntz``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast(T.DoubleType())
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast(T.TimestampNTZType())
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str) -> Callable[[Query], Query]:
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            token = _MEMO.set({})
            try:
                return comparable(fn(spark, sf_dir))
            finally:
                _MEMO.reset(token)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run

    return wrap


def queries() -> dict[str, Query]:
    # Importing the query modules fills QUERIES.
    from railyard.plans import (  # noqa: F401
        queries_batch,
        queries_core,
        queries_io,
        queries_quality,
        queries_store,
        queries_stream,
        queries_warehouse,
    )

    return dict(QUERIES)


__all__ = ["QUERIES", "comparable", "per_query", "register", "queries", "fx"]
