"""What the operators share: reading a table, words, written tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.session import written  # noqa: F401 - what the operators cut lineage with

#: White space of the contracts: U+0020 and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table; other columns never travel along."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, SPACES))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def settled(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with the named columns computed before anything above filters.

    A filter is otherwise copied down through projections, and with it whole
    expressions into the lambdas of others, where they run once per element.
    Exploding an array of one struct stops that.
    """
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*columns))))


def in_written_order(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns and where each row stands in the table it was read
    from: ``place``, the number of its file and its row there.

    Spark deals files to tasks by their size, so a table that was written in
    order does not come back in order; sorting by ``place`` restores it. Rows
    that were not read from files are placed by partition.
    """
    try:
        number = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
        place = F.struct(number.try_cast("long").alias("part"), F.col("_metadata.file_name"), F.col("_metadata.row_index"))
        return df.select(*columns, place.alias("place"))
    except AnalysisException:
        return df.select(*columns, F.struct(F.monotonically_increasing_id().alias("row")).alias("place"))
