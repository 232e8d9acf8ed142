"""Calendars (J5, J6) and the command line (J12 entry)."""

import datetime as dt

from pyspark.sql import functions as F

from testdata import SMALL
from landing import land
from railyard.cli import main
from railyard.operators import calendar as cal


def test_dim_date_iso_weeks_across_year_end(spark):
    bounds = spark.createDataFrame([(dt.date(2020, 12, 28), dt.date(2021, 1, 4))], "lo date, hi date")
    rows = {r.full_date: r for r in cal.dim_date(bounds).collect()}
    assert len(rows) == 8
    assert rows[dt.date(2021, 1, 1)].week == 53 and rows[dt.date(2021, 1, 4)].week == 1
    assert rows[dt.date(2021, 1, 2)].is_weekend and not rows[dt.date(2021, 1, 4)].is_weekend
    assert rows[dt.date(2020, 12, 31)].date_sk == 20201231 and rows[dt.date(2020, 12, 31)].quarter == 4


def test_dim_time_full_day(spark):
    t = cal.dim_time_full(spark)
    assert t.count() == 86400
    r = t.filter(F.col("time_sk") == 3723).first()
    assert (r.hh24mi, r.hour, r.minute, r.second) == ("01:02", 1, 2, 3)


def test_cli_batch_then_mart(spark, workdir):
    raw, wh = f"{workdir}/raw", f"{workdir}/wh"
    land(spark, SMALL, raw, "2024-02-01")
    out = main(["batch", "--raw", raw, "--warehouse", wh, "--date", "2024-02-01"])
    assert out["fact_trip"] > 0
    mart = main(["mart", "--warehouse", wh, "--date-from", "2024-01-05", "--date-to", "2024-01-20"])
    assert mart["mart_rows"] > 0
