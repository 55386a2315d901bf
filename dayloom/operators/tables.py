"""Day-partitioned tables: definition, the write modes, and retention.

Every write mode is a function of its own; none is a flag of another, except ``full_refresh``.
Parquet tables have no transactions: one writer per table at a time.
"""

from __future__ import annotations

import uuid
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from dayloom.operators.fingerprints import difference
from dayloom.operators.ledger import NULL_DAY, Ledger, Touched
from dayloom.operators.quality import Watch
from dayloom.operators.rollup import day_list
from dayloom.operators.sizes import broadcast_if_small, clustered


def create_table(spark: SparkSession, table: str, schema: T.StructType, day: str) -> None:
    """Define an empty Parquet table partitioned by ``day``."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{day}`)")


def _arranged(df: DataFrame, day: str, cluster_by: list[str] | None) -> DataFrame:
    return df if cluster_by is None else clustered(df, day, cluster_by)


def _entered(ledger: Ledger | None, days: list | None = None) -> AbstractContextManager[Touched]:
    return nullcontext(Touched()) if ledger is None else ledger.writing(days=days)


def observed(seen: Observation, name: str, default):
    """What was observed; the default when nothing was, as a shuffle without rows is planned away with what watches it."""
    try:
        return seen.get[name]
    except Py4JJavaError:
        return default


def append(df: DataFrame, table: str, day: str = "load_date", cluster_by: list[str] | None = None,
           ledger: Ledger | None = None, watch: Watch | None = None) -> None:
    """Append rows as they are; appending twice doubles them. A missing table is an error.

    Without ``cluster_by`` this is one map-only stage, right for landed data that is already
    foldered by day; with it the rows are gathered by day first. A ``ledger`` gets what the days met then hold,
    a ``watch`` counts for its checks what is written.
    """
    target = df.sparkSession.table(table)
    rows = _arranged(df.select(*target.columns), day, cluster_by)
    rows = rows if watch is None else watch.on(rows)
    with _entered(ledger) as touched:
        if ledger is None:
            rows.write.insertInto(table)
            return
        seen = Observation()
        rows.observe(seen, F.collect_set(F.coalesce(F.col(day).cast("string"), F.lit(NULL_DAY))).alias("days")).write.insertInto(table)
        touched.add(observed(seen, "days", []))


def rebuild(df: DataFrame, table: str, day: str | None = None, cluster_by: list[str] | None = None) -> None:
    """Drop and recreate the table from ``df``."""
    writer = (df if day is None else _arranged(df, day, cluster_by)).write.mode("overwrite").format("parquet")
    (writer if day is None else writer.partitionBy(day)).saveAsTable(table)


@dataclass(frozen=True)
class Landed:
    """What an incremental append did with its input."""

    appended_rows: int
    skipped_rows: int
    new_days: tuple = ()
    unwatched_days: tuple = ()  # of the new days those that a second write has filled, past the watch


def append_new_days(df: DataFrame, table: str, day: str = "load_date", full_refresh: bool = False,
                    cluster_by: list[str] | None = None, ledger: Ledger | None = None,
                    watch: Watch | None = None) -> Landed:
    """Append only the rows of days the table does not have yet; the first run creates the table.

    Days are taken or left whole: a late row of a landed day is NOT appended. Such rows are
    counted in ``skipped_rows``, ``late_rows`` shows them, and ``streaming.ingest`` is the way that
    loses none. With a ``ledger`` the days at hand are its days, and no part of the table is read to
    decide or to count. Without one they are the catalog's partitions; of those, only the ones that
    the source offers too are looked into, in one query, since a partition without rows is no day at hand.
    """
    spark = df.sparkSession
    if full_refresh or not spark.catalog.tableExists(table):
        if ledger is not None:
            ledger.forget()
        rebuild(df if watch is None else watch.on(_arranged(df, day, cluster_by)), table, day, None if watch else cluster_by)
        if ledger is not None:
            held = ledger.days()
            return Landed(sum(h.rows for h in held.values()), 0, tuple(ledger.typed(held)))
        return Landed(spark.table(table).count(), 0, _typed(spark, table, day, partition_days(spark, table, day)))
    present = spark.table(table)
    source = df.select(*present.columns)
    held = None if ledger is None else ledger.days()
    before = partition_days(spark, table, day) if held is None else sorted(held)
    if NULL_DAY in before and (held or not present.where(F.col(day).isNull()).isEmpty()):
        return Landed(0, source.count())  # NOT IN: beside a NULL day no day is known to be absent
    known = list(_typed(spark, table, day, before))
    met = F.collect_set(F.when(F.col(day).isin(known), F.col(day)))  # at most the days at hand
    seen = Observation()
    offers = source.observe(seen, F.count(F.lit(1)).alias("rows"), met.alias("met"))
    wanted = offers.where(offers[day].isNotNull() & ~offers[day].isin(known)) if known else offers
    arranged = _arranged(wanted, day, cluster_by)
    arranged = arranged if watch is None else watch.on(arranged)
    if ledger is not None:
        new = Observation()
        with ledger.writing(new_days_only=True) as touched:
            arranged.observe(new, F.collect_set(F.coalesce(F.col(day).cast("string"), F.lit(NULL_DAY))).alias("days")).write.insertInto(table)
            touched.add(observed(new, "days", []))
        after = ledger.days()
        added = {d: h for d, h in after.items() if d not in held}
        appended = sum(h.rows for h in added.values())
        rows = observed(seen, "rows", None)
        return Landed(appended, (source.count() if rows is None else rows) - appended, tuple(ledger.typed(added)))
    arranged.write.insertInto(table)
    rows, offered = observed(seen, "rows", None), observed(seen, "met", [])
    if rows is None:
        rows, offered = source.agg(F.count(F.lit(1)), met).first()
    offered = [d for d in offered if d is not None]
    filled = {r[0] for r in present.where(F.col(day).isin(offered)).select(day).distinct().collect()} if offered else set()
    empty = [d for d in offered if d not in filled]
    if empty:  # partitions without rows, as a failed write leaves them: the rows are new after all
        again = _arranged(source.where(F.col(day).isin(empty)), day, cluster_by)
        again.write.insertInto(table)
    after = _typed(spark, table, day, partition_days(spark, table, day))
    new = tuple(sorted({*after} - {*known} | {*empty}, key=str))
    # from the new partitions: tasks behind a shuffle may run twice and count their rows twice
    written_days = spark.table(table).where(F.col(day).isin(list(new)) if known else F.lit(True))
    appended = written_days.count() if new else 0
    return Landed(appended, rows - appended, new, tuple(sorted(empty, key=str)))


def _typed(spark: SparkSession, table: str, day: str, days: list[str]) -> tuple:
    """Catalog days in the type of the column; the partition of NULL days is left out."""
    days = sorted(d for d in days if d != NULL_DAY)
    if isinstance(spark.table(table).schema[day].dataType, T.DateType):
        return tuple(date.fromisoformat(d) for d in days)
    return tuple(days)


LINEAGE = "source_file"


def late_rows(df: DataFrame, table: str, day: str = "load_date", by: list[str] | None = None) -> DataFrame:
    """The rows that ``append_new_days`` leaves out and the table lacks, with their number of copies.

    Both sides are looked at on the days they share only. Rows are compared within the groups of ``by`` beside the day,
    by default the file they come from: groups with one fingerprint on both sides are ruled out, and only the rows of
    the others are counted one by one. Rows without lineage are compared by the day's rows as a whole.
    """
    spark = df.sparkSession
    present = spark.table(table)
    days = list(_typed(spark, table, day, partition_days(spark, table, day)))
    source = df.select(*present.columns).where(F.col(day).isin(days))
    shared = [d for d in day_list(source, day) or days if d is not None]
    present = present.where(F.col(day).isin(shared))
    # a partition without rows is no day at hand
    filled = [r[0] for r in present.select(day).distinct().collect()] if shared else []
    source = source.where(F.col(day).isin(filled))
    by = [c for c in ([LINEAGE] if by is None else by) if c in present.columns]
    if by:
        differs = broadcast_if_small(difference(source, present, [day, *by]).select(
            *(F.col(c).alias(f"_{c}") for c in [day, *by])))
        match = F.lit(True)
        for c in [day, *by]:
            match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
        source, present = (side.join(differs, match, "left_semi") for side in (source, present))
    return source.exceptAll(present)


def refresh_dates_in_source(df: DataFrame, table: str, day: str = "load_date", cluster_by: list[str] | None = None,
                            ledger: Ledger | None = None) -> None:
    """Replace exactly the days that occur in ``df``; other days keep their rows.

    The new files are staged and swapped in by partition when the job commits. Rows are gathered
    by day first, so a day gets few files. A day without rows in ``df`` is not touched: to empty a
    day use ``refresh_one_date``. A ``ledger`` gets what those days then hold.
    """
    with _entered(ledger, None if ledger is None else day_list(df, day)):
        overwrite_partitions(clustered(df, day, cluster_by or []), table)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that occur in ``df``, in a session of its own.

    Which partitions an overwrite replaces is a setting of the session, not of the write; another
    thread's overwrite in the caller's session must not see it change.
    """
    spark = df.sparkSession
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    view = f"rows_{uuid.uuid4().hex}"
    df.select(*spark.table(table).columns).createGlobalTempView(view)
    try:
        own.table(f"global_temp.{view}").write.insertInto(table, overwrite=True)
    finally:
        spark.catalog.dropGlobalTempView(view)
        spark.catalog.refreshTable(table)


def refresh_one_date(df: DataFrame, table: str, day: str, run_date: str | date, ledger: Ledger | None = None) -> None:
    """Replace the rows of one date, whether or not ``df`` has any: without rows the date ends empty.

    Rows are gathered first: few files, split over tasks only where the day is large.
    """
    spark = df.sparkSession
    run_date = run_date if isinstance(run_date, date) else date.fromisoformat(run_date)
    target = spark.table(table)
    of_day = df.where(F.col(day) == F.lit(run_date.isoformat()).cast(target.schema[day].dataType))
    with _entered(ledger, [run_date]):
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (`{day}` = '{run_date.isoformat()}') SELECT * FROM {{rows}}",
            rows=of_day.select(*[c for c in target.columns if c != day]).hint("rebalance"),
        )


def truncate(spark: SparkSession, table: str, ledger: Ledger | None = None) -> None:
    """Remove all rows, keep the definition."""
    with _entered(ledger, None if ledger is None else list(ledger.days())):
        spark.sql(f"TRUNCATE TABLE {table}")


def partition_days(spark: SparkSession, table: str, day: str) -> list[str]:
    """The days a table has a partition for, from the catalog."""
    prefix = f"{day}="
    found = (row[0].split("/")[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return sorted({part[len(prefix):] for part in found})


def within_retention(df: DataFrame, day: str, as_of: str | date, days: int = 7) -> DataFrame:
    """The rows retention would keep: those of the last ``days`` days up to ``as_of``."""
    return df.where(F.to_date(day) > F.date_sub(F.lit(str(as_of)).cast("date"), days))


def expire(spark: SparkSession, table: str, day: str, as_of: str | date, days: int = 7,
           ledger: Ledger | None = None) -> list[str]:
    """Drop the partitions of days that retention does not keep; returns those days.

    Age is that of the partition day, not of the files.
    """
    as_of = as_of if isinstance(as_of, date) else date.fromisoformat(as_of)
    limit = (as_of - timedelta(days)).isoformat()
    old = [d for d in partition_days(spark, table, day) if d <= limit]
    if old:
        parts = [[p.split("=", 1) for p in row[0].split("/")] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        specs = ", ".join("PARTITION (" + ", ".join(f"`{k}` = '{v}'" for k, v in part) + ")"
                          for part in parts if dict(part).get(day) in old)
        with _entered(ledger, old):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return old
