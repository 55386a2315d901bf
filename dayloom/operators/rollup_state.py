"""The daily rollup as sums that merge: late rows are added to what a day has, without reading the day again.

Averages do not merge; sums and counts do. The state is a table by day with, for each key, the number of rows and of
each measure the sum and the number of values. A batch of rows is rolled up by itself and added to the days it meets,
whose few state rows are all that is read and written again; the facts are not touched. Each day remembers the batches
it has taken, so a batch that comes again, or is resumed after a crash, adds to the days that lack it and to no other.

Sums are doubles: a merged average may differ from a fresh one in its last digit, as two fresh ones may.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dayloom.functions.numbers import round_scaled
from dayloom.operators import tables
from dayloom.operators.rollup import day_list
from dayloom.operators.sizes import broadcast_if_small
from dayloom.schemas import Feed
from dayloom.session import staged

BATCHES = "batches"


def state_schema(feed: Feed) -> T.StructType:
    key_types = {f.name: f.dataType for f in feed.summary_schema().fields}
    sums = [f for m in feed.measures for f in (T.StructField(f"sum_{m}", T.DoubleType()), T.StructField(f"n_{m}", T.LongType()))]
    return T.StructType([*(T.StructField(k, key_types[k]) for k in feed.keys), T.StructField("record_count", T.LongType()),
                         *sums, T.StructField(BATCHES, T.ArrayType(T.StringType())), feed.day_field()])


def create_state(spark: SparkSession, table: str, feed: Feed) -> None:
    tables.create_table(spark, table, state_schema(feed), feed.day)


def _summed(rows: DataFrame, feed: Feed, counted: bool) -> DataFrame:
    """Sums by day and key: of facts, or of state rows that are ``counted`` already."""
    def parts(measure: str):
        value = F.col(f"sum_{measure}") if counted else F.col(measure).cast("double")
        number = F.sum(f"n_{measure}") if counted else F.count(measure)
        return F.sum(value).alias(f"sum_{measure}"), number.alias(f"n_{measure}")

    rows_of = F.sum("record_count") if counted else F.count(F.lit(1))
    return rows.groupBy(feed.day, *feed.keys).agg(
        rows_of.alias("record_count"), *(part for m in feed.measures for part in parts(m)))


def state_of(facts: DataFrame, feed: Feed) -> DataFrame:
    """The state of rows, as one batch without a name. Rows are combined before the shuffle."""
    return _summed(facts, feed, counted=False)


def merge(spark: SparkSession, table: str, rows: DataFrame, batch: str, feed: Feed) -> list:
    """Add the rows of ``batch`` to the state; returns the days that took them.

    Days that have the batch already are left as they are. Each day's partition is swapped as a whole, with the batch in its
    list. Rows without a day are no day's.
    """
    day = feed.day
    columns = [f.name for f in state_schema(feed).fields]
    with staged(state_of(rows, feed).where(F.col(day).isNotNull()), "rolled-up") as delta:
        met = [d for d in day_list(delta, day) or [] if d is not None]
        if not met:
            return []
        held = spark.table(table).where(F.col(day).isin(met))
        taken = held.groupBy(F.col(day).alias("_day")).agg(
            F.array_distinct(F.flatten(F.collect_set(BATCHES))).alias("_taken"))
        done = {r[0] for r in taken.where(F.array_contains("_taken", batch)).select("_day").collect()}
        open_days = sorted(d for d in met if d not in done)
        if not open_days:
            return []
        both = held.select(*(c for c in columns if c != BATCHES)).unionByName(delta).where(F.col(day).isin(open_days))
        merged = _summed(both, feed, counted=True).join(broadcast_if_small(taken), F.col(day) == F.col("_day"), "left")
        listed = F.array_append(F.coalesce("_taken", F.array().cast("array<string>")), F.lit(batch))
        tables.refresh_dates_in_source(merged.withColumn(BATCHES, listed).select(*columns), table, day, list(feed.keys))
        return open_days


def rollup_of(state: DataFrame, feed: Feed, round_digits: int | None = None) -> DataFrame:
    """The daily summary that the state stands for; an average without values is NULL."""
    def average(measure: str):
        mean = F.when(F.col(f"n_{measure}") > 0, F.col(f"sum_{measure}") / F.col(f"n_{measure}"))
        return (mean if round_digits is None else round_scaled(mean, round_digits)).alias(f"avg_{measure}")

    return state.select(*feed.keys, "record_count", *(average(m) for m in feed.measures), feed.day)
