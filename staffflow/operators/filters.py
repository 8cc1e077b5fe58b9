"""Row filters, written so that they reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_year_range(df: DataFrame, first: int = 2015, last: int = 2025) -> DataFrame:
    return df.filter(F.col("year").between(first, last))


def drop_retired(df: DataFrame) -> DataFrame:
    """Keeps rows without a status, as an inequality over missing values does."""
    return df.filter(~F.col("status").eqNullSafe("Retired"))


def filter_status_in(df: DataFrame, statuses: list[str]) -> DataFrame:
    return df.filter(F.col("status").isin(statuses))


def latest_period_snapshot(
    df: DataFrame, label: str = "turnover", as_of: tuple[int, int] | None = None, full_share: float = 0.0
) -> DataFrame:
    """Rows of the last month of the last year whose label is 0.

    With ``as_of``, a (year, month), later months are not looked at. A month with less than
    ``full_share`` of the rows of the median month counts as not delivered yet. The period is a
    scalar subquery: it runs first and its value prunes the (year, month) partitions of a stored
    panel.
    """
    known = df
    if as_of is not None:
        known = df.filter(F.struct("year", "month") <= F.struct(F.lit(as_of[0]).alias("year"), F.lit(as_of[1]).alias("month")))
    if full_share > 0:
        months = known.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))
        usual = months.agg(F.median("n").alias("n")).select("n").scalar()
        known = months.filter(F.col("n") >= F.lit(float(full_share)) * usual)
    last = known.agg(F.max(F.struct("year", "month")).alias("p"))
    year = last.select("p.year").scalar()
    month = last.select("p.month").scalar()
    return df.filter((F.col("year") == year) & (F.col("month") == month) & (F.col(label) == 0))


def score_above_threshold(df: DataFrame, score: str, threshold: float) -> DataFrame:
    return df.filter(F.col(score) > F.lit(float(threshold)))


def drop_incomplete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def event_year_filter(df: DataFrame, date: str, year: int) -> DataFrame:
    """Rows whose date lies in a year, as a range on the bare column."""
    low, high = F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year + 1}-01-01").cast("date")
    return df.filter((F.col(date) >= low) & (F.col(date) < high))
