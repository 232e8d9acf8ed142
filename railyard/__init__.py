"""railyard: a Spark-native transit warehouse toolkit.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark's own expressions, so Catalyst sees the whole plan: filters reach the
Parquet scan, joins pick broadcast or sort-merge by measured size, and
aggregations combine map-side before shuffling.

Sub-packages:
    sources    Parquet landing / staging / versioned tables, JDBC edges
    functions  column expressions shared by the operators
    operators  conform, dedupe, quality, surrogate keys, lookups, SCD1/SCD2,
               calendars, hourly aggregates
    plans      composed jobs: dimension and fact loads, the route mart,
               the batch run, ETA features, the TESTDATA role mapping
    streaming  position stream: windowed route speed, dedupe, staging sink
"""

from railyard.session import get_session, prepare_session

__all__ = ["get_session", "prepare_session"]
