"""The daily jobs, composed from the operators. Every job takes its run date as an argument."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from dayloom.operators import quality, tables
from dayloom.operators.ledger import Ledger
from dayloom.operators.rollup import daily_rollup, on_day, rows_per_day
from dayloom.operators.validate import accepted, classify, rejected
from dayloom.schemas import WEATHER, Feed
from dayloom.session import staged, use_utc
from dayloom.sources.landing import FOLDER_DAY, land_ndjson, parse_lines, scan_lines, scan_run_date


@dataclass(frozen=True)
class Lake:
    """Where a feed lives: landing root, tables, and how records are read."""

    root: str
    facts: str
    summary: str
    rejects: str | None = None
    feed: Feed = WEATHER
    mode: str = "quarantine"
    timestamp_rule: str = "tolerant"
    lineage: str = "file"
    milliseconds: bool = False
    cluster_by: tuple[str, ...] | None = None
    ledger: bool = False  # keep what each day of the facts holds in a table beside them

    def clustering(self) -> list[str] | None:
        return None if self.cluster_by is None else list(self.cluster_by)


def ledger_of(spark: SparkSession, lake: Lake) -> Ledger | None:
    """The ledger of the facts, if the lake keeps one."""
    return Ledger(spark, lake.facts, lake.feed.day).create() if lake.ledger else None


def summarised(spark: SparkSession, lake: Lake) -> Ledger:
    """What the fact days held when their summary was last made and reconciled."""
    return Ledger(spark, lake.summary, lake.feed.day, "_source").create()


def create_tables(spark: SparkSession, lake: Lake) -> None:
    """Define the fact, summary and reject tables; the append jobs never create them."""
    feed = lake.feed
    tables.create_table(spark, lake.facts, feed.fact_schema(), feed.day)
    tables.create_table(spark, lake.summary, feed.summary_schema(), feed.day)
    if lake.rejects:
        spark.sql(f"CREATE TABLE {lake.rejects} (source_file string, raw_line string, reason string, "
                  "load_date string) USING parquet PARTITIONED BY (load_date)")


def _classified(lines: DataFrame, lake: Lake) -> DataFrame:
    return classify(parse_lines(lines, lake.feed), lake.feed, lake.mode, lake.timestamp_rule, lake.milliseconds)


def staging(spark: SparkSession, lake: Lake, start: str | date | None = None,
            end: str | date | None = None, view: str | None = None) -> DataFrame:
    """The typed, accepted records of the landing zone; stores nothing. ``view`` names it for SQL."""
    use_utc(spark)
    rows = accepted(_classified(scan_lines(spark, lake.root, start, end, lake.lineage), lake), lake.feed)
    if view:
        rows.createOrReplaceTempView(view)
    return rows


def summarise(facts: DataFrame, feed: Feed, round_digits: int | None) -> DataFrame:
    return daily_rollup(facts, feed.day, list(feed.keys), list(feed.measures), round_digits)


def load_run_date(spark: SparkSession, lake: Lake, run_date: str | date, on_missing: str = "fail") -> None:
    """Parse one run date's folder and append its records, and its rejects when a table is named.

    With a reject table the classified records are written once and both tables are filled from
    that, so the JSON is decoded once; without one the append reads the landing zone directly.
    """
    use_utc(spark)
    classified = _classified(scan_run_date(spark, lake.root, run_date, lake.lineage, on_missing), lake)

    def fill_facts(rows: DataFrame) -> None:
        tables.append(accepted(rows, lake.feed), lake.facts, lake.feed.day, lake.clustering(), ledger_of(spark, lake))

    if not lake.rejects:
        fill_facts(classified)
        return
    with staged(classified, "classified") as once:
        tables.append(rejected(once), lake.rejects, "load_date")
        fill_facts(once)


def run_daily(spark: SparkSession, lake: Lake, run_date: str | date, incoming: DataFrame | None = None,
              least_rows: int = 4, round_digits: int | None = 2, gate_at: str = "after_summary") -> DataFrame:
    """Land ``incoming``, append it, refresh that date's summary, and gate on the rows of the date.

    The gate comes after the summary by default, so a failure does not undo it; ``before_summary``
    leaves the summary untouched on failure. Returns the date's summary.
    """
    if gate_at not in ("before_summary", "after_summary"):
        raise ValueError("gate_at must be 'before_summary' or 'after_summary'")
    use_utc(spark)
    feed = lake.feed
    if incoming is not None:
        land_ndjson(incoming, lake.root, datetime.fromisoformat(str(run_date)))
    load_run_date(spark, lake, run_date)

    def enough() -> None:
        if lake.ledger:  # the append has counted the day
            held = ledger_of(spark, lake).days().get(str(run_date))
            few = int((held.rows if held else 0) < least_rows)
            quality.gate([Row(check_name="min_rows_of_day", violations=few, status="FAIL" if few else "PASS")])
            return
        rows = on_day(spark.table(lake.facts), feed.day, run_date)
        quality.gate(quality.report(rows, [quality.MinRowsCheck("min_rows_of_day", least_rows)]))

    if gate_at == "before_summary":
        enough()
    rollup = summarise(on_day(spark.table(lake.facts), feed.day, run_date), feed, round_digits)
    tables.refresh_one_date(rollup, lake.summary, feed.day, run_date)
    if gate_at == "after_summary":
        enough()
    return on_day(spark.table(lake.summary), feed.day, run_date)


def build_all(spark: SparkSession, lake: Lake, full_refresh: bool = False, checks: list | None = None,
              round_digits: int | None = 2, start: str | date | None = None, end: str | date | None = None,
              only_new_days: bool = False) -> tuple[tables.Landed, list]:
    """Append the new days of the landing zone, test the facts, rebuild the summary, reconcile it.

    A failing fact test raises before the summary is touched. ``start`` and ``end`` leave older
    and later landing folders unread. ``only_new_days`` tests, summarises and reconciles the days
    appended and those whose rows the summary does not have: a day whose test failed, or that a
    crash left without its summary, stays in the next run until it has passed. Other days are
    unchanged since they passed. Returns what was appended and the rows of both reports.

    The tests of the rows appended are counted while they are written; only uniqueness reads them again. With a
    ledger the days whose summary is stale come from it: those whose rows are not the ones that were last summarised,
    changed rows of an unchanged number included. Without one the days' row counts are compared.
    """
    feed, checks = lake.feed, quality.model_checks() if checks is None else checks
    scoped = only_new_days and not full_refresh and spark.catalog.tableExists(lake.summary)
    whole = full_refresh or not spark.catalog.tableExists(lake.facts)
    ledger, watch = ledger_of(spark, lake), quality.Watch(checks)
    landed = tables.append_new_days(
        staging(spark, lake, start, end), lake.facts, feed.day, full_refresh, lake.clustering(), ledger, watch)
    held = None if ledger is None else ledger.days()
    stale = None
    if scoped:
        stale = unsummarised_days(spark, lake) if ledger is None else stale_days(spark, lake, ledger, held)
    days = sorted({*landed.new_days, *stale}, key=str) if scoped else None
    facts = _facts(spark, lake, days)
    seen = [d for d in landed.new_days if d not in landed.unwatched_days]
    if whole:
        beside = None
    elif scoped:
        beside = _facts(spark, lake, [d for d in days if d not in seen])
    else:
        beside = facts.where(~F.col(feed.day).isin(seen)) if seen else facts
    passed = quality.gate(watch.report(facts, beside))
    rollup = summarise(facts, feed, round_digits)
    if scoped:
        tables.refresh_dates_in_source(rollup, lake.summary, feed.day, list(feed.keys))
    else:
        tables.rebuild(rollup, lake.summary, feed.day, list(feed.keys))
    reconciled = quality.ReconcileCheck(
        "summary_reconciles_source", spark.table(lake.summary), day=feed.day,
        days=tuple(days) if scoped else None)
    if ledger is None:
        return landed, passed + quality.gate(quality.report(facts, [reconciled]))
    of_days = {d: h for d, h in held.items() if days is None or d in set(map(str, days))}
    summed = quality.total(reconciled.summary.where(F.col(feed.day).isin(days) if scoped else F.lit(True)), "record_count", "n")
    gap = abs(sum(h.rows for h in of_days.values()) - summed.first()["n"])
    passed += quality.gate([Row(check_name=reconciled.name, violations=gap, status="FAIL" if gap else "PASS")])
    summarised(spark, lake).enter(of_days)
    return landed, passed


def stale_days(spark: SparkSession, lake: Lake, ledger: Ledger, held: dict) -> list:
    """Fact days whose rows are not those that were last summarised, by the two ledgers; no table is scanned."""
    made = summarised(spark, lake).entered()
    return ledger.typed(d for d, h in held.items() if not h.same_rows(made.get(d)))


def unsummarised_days(spark: SparkSession, lake: Lake) -> list:
    """Fact days whose number of rows is not the one in the summary; days are few, as a calendar is."""
    day = lake.feed.day
    counted = rows_per_day(spark.table(lake.facts), day)
    held = spark.table(lake.summary).groupBy(F.col(day).alias("held_day")).agg(F.sum("record_count").alias("held"))
    differ = counted.join(held, F.col(day) == F.col("held_day"), "left").where(
        F.col(day).isNotNull() & ~F.col("row_count").eqNullSafe(F.col("held")))
    return [row[0] for row in differ.select(day).collect()]


def _facts(spark: SparkSession, lake: Lake, days: list | None) -> DataFrame:
    facts = spark.table(lake.facts)
    return facts if days is None else facts.where(F.col(lake.feed.day).isin(list(days)))


def refresh_summary(spark: SparkSession, lake: Lake, round_digits: int | None = None,
                    days: list | None = None) -> None:
    """Recompute the summary of every day the facts have; summary days without facts stay.

    ``days`` recomputes only those and reads only their partitions.
    """
    use_utc(spark)
    feed = lake.feed
    tables.refresh_dates_in_source(
        summarise(_facts(spark, lake, days), feed, round_digits), lake.summary, feed.day, list(feed.keys))


def quality_report(spark: SparkSession, lake: Lake, checks: list | None = None,
                   days: list | None = None) -> DataFrame:
    """The report card over facts and summary, of all days or of the partitions of ``days``.

    Readings of different days are never duplicates of each other, so checking the days a run has
    changed is enough once the others have passed.
    """
    if checks is None:
        checks = quality.warehouse_checks(
            spark.table(lake.summary), lake.feed.day, None if days is None else tuple(days))
    return quality.report(_facts(spark, lake, days), checks)


def lost_records(spark: SparkSession, lake: Lake, start: str | date | None = None,
                 end: str | date | None = None) -> DataFrame:
    """Valid landed records against fact rows, per day and source file: those lost, and those doubled or other.

    Files whose rows have one fingerprint on both sides are ruled out by it. A record that has changed since is one
    lost row and one of surplus.

    ``start`` and ``end`` bound the landing folders and the fact days: give the days that landing
    still keeps, as facts outlive it. A record late in the day of its folder may be of the day
    before, so facts count by their file where the file is one of a folder read.
    """
    feed = lake.feed
    rows = staging(spark, lake, start, end)
    facts = spark.table(lake.facts)
    if start is not None or end is not None:
        folder = F.regexp_extract("source_file", f"{FOLDER_DAY}=([^/]+)", 1)
        first, last = "" if start is None else str(start), "~" if end is None else str(end)
        facts = facts.where(folder.between(first, last))
    return quality.reconcile_rows(rows, facts, [feed.day, "source_file"])
