"""Per-day rollups and day helpers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from dayloom.functions.numbers import round_scaled
from dayloom.functions.timestamps import day_of
from dayloom.session import use_utc

MANY_DAYS = 40_000  # over a century of days: beyond this a "day" list is not taken to the driver


def with_day(df: DataFrame, instant: str, day: str = "load_date", day_type: str = "string") -> DataFrame:
    """Derive the partition column from the event time; it comes last, as partitioned tables need it."""
    use_utc(df.sparkSession)
    return df.select(*[c for c in df.columns if c != day], day_of(F.col(instant), day_type).alias(day))


def on_day(df: DataFrame, day: str, run_date: str | date) -> DataFrame:
    """The rows of one day, by the partition column: a predicate on the event time prunes no folder."""
    return df.where(F.col(day) == F.lit(str(run_date)).cast(df.schema[day].dataType))


def daily_rollup(df: DataFrame, day: str, keys: list[str], measures: list[str],
                 round_digits: int | None = None) -> DataFrame:
    """``record_count`` and one average per measure for every day and key.

    Averages skip NULL, the count does not. Rows are combined before the shuffle, so what moves
    is one row per task and group, whatever share of the input a group holds. Day comes last.
    """
    def average(measure: str) -> Column:
        mean = F.avg(measure)
        return (mean if round_digits is None else round_scaled(mean, round_digits)).alias(f"avg_{measure}")

    return (
        df.groupBy(day, *keys)
        .agg(F.count(F.lit(1)).alias("record_count"), *[average(m) for m in measures])
        .select(*keys, "record_count", *[f"avg_{m}" for m in measures], day)
    )


def rows_per_day(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("row_count"))


def landed_days(df: DataFrame, day: str) -> DataFrame:
    """The distinct days of a table; on a partitioned table no data column is read."""
    return df.select(day).distinct()


def day_list(df: DataFrame, day: str, most: int = MANY_DAYS) -> list | None:
    """The distinct days as a Python list, or None when there are more than ``most``."""
    days = [row[0] for row in landed_days(df, day).limit(most + 1).collect()]
    return days if len(days) <= most else None


def present_days(df: DataFrame, other: DataFrame, day: str, most: int = MANY_DAYS) -> DataFrame:
    """Rows whose day occurs in ``other`` (``IN``).

    A short list of days becomes a literal filter, which reaches the scan and prunes partitions;
    otherwise the subquery is a semi join.
    """
    days = day_list(other, day, most)
    return df.where(F.col(day).isin(landed_days(other, day) if days is None else days))


def absent_days(df: DataFrame, other: DataFrame, day: str, null_aware: bool = True,
                most: int = MANY_DAYS) -> DataFrame:
    """Rows whose day does not occur in ``other``.

    ``null_aware`` is SQL's ``NOT IN``: a NULL day is never kept once ``other`` has rows, and one
    NULL day in ``other`` empties the result. Without it NULL equals nothing, as in an anti join.
    """
    return days_not_in(df, day_list(other, day, most), other, day, null_aware)


def days_not_in(df: DataFrame, days: list | None, other: DataFrame, day: str, null_aware: bool = True) -> DataFrame:
    """``absent_days`` when ``days``, the result of ``day_list(other)``, is at hand.

    Beyond a list a plain anti join does it, which may shuffle; a NOT IN subquery would broadcast
    the days whatever their number. What NULL means is settled by counting first.
    """
    if days is None:
        if not null_aware:
            return df.join(landed_days(other, day), day, "left_anti")
        rows, nulls = other.agg(F.count(F.lit(1)), F.count_if(F.col(day).isNull())).first()
        if not rows:
            return df
        if nulls:
            return df.where(F.lit(False))
        return df.where(F.col(day).isNotNull()).join(landed_days(other, day), day, "left_anti")
    if null_aware:
        return df.where(~F.col(day).isin(days))
    known = [d for d in days if d is not None]
    return df.where(F.col(day).isNull() | ~F.col(day).isin(known))


def min_rows(df: DataFrame, least: int = 4) -> DataFrame:
    """One row: how many rows there are and whether that is enough."""
    counted = F.count(F.lit(1))
    return df.agg(counted.alias("row_count"), (counted >= least).alias("enough"))
