"""Per-query memo for shared building blocks.

Building blocks shared inside one query (a table read, a dimension
referenced by several lookups, the trip fact reused by the payment fact) are
built once per query call: their size checks and checkpoints are then taken
once, and every reference reads the same plan.
"""

from __future__ import annotations

from contextvars import ContextVar
from functools import wraps

_MEMO: ContextVar[dict | None] = ContextVar("railyard_query_memo", default=None)


def per_query(fn):
    def ident(v):
        return v if isinstance(v, (str, int, float, bool, type(None))) else id(v)

    @wraps(fn)
    def wrapped(spark, sf_dir, *args, **kwargs):
        memo = _MEMO.get()
        if memo is None:
            return fn(spark, sf_dir, *args, **kwargs)
        key = (
            fn.__module__,
            fn.__qualname__,
            sf_dir,
            tuple(ident(a) for a in args),
            tuple(sorted((k, ident(v)) for k, v in kwargs.items())),
        )
        if key not in memo:
            # keep the arguments alive so their ids stay unique in the key
            memo[key] = (fn(spark, sf_dir, *args, **kwargs), args, kwargs)
        return memo[key][0]

    return wrapped



__all__ = ["per_query"]
