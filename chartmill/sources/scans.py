"""Scans over refined tables: views, column and time-range reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def register_views(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Each frame as a temporary view; returns the view names."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in tables]


def scan_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def month_bounds(year: int, month: int | None = None) -> tuple[datetime, datetime]:
    """Half-open bounds of a year or of one month; December ends on 1 January."""
    if month is None:
        return datetime(year, 1, 1), datetime(year + 1, 1, 1)
    following = datetime(year + 1, 1, 1) if month == 12 else datetime(year, month + 1, 1)
    return datetime(year, month, 1), following


def _bound(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def scan_time_range(df: DataFrame, ts: str, lo: datetime, hi: datetime, year_column: str | None = None) -> DataFrame:
    """Rows with lo <= ts < hi.

    A predicate on the timestamp does not prune year folders, so the matching predicate on the
    partition column is added when the table has one.
    """
    kept = df.where((F.col(ts) >= _bound(lo)) & (F.col(ts) < _bound(hi)))
    if year_column is None:
        return kept
    last = hi.year - 1 if hi == datetime(hi.year, 1, 1) else hi.year
    return kept.where(F.col(year_column).between(lo.year, last))
