"""Data-quality checks. Every check counts violations; zero is a pass.

All row-level checks and the row count run in one aggregate over one scan. A uniqueness check
needs the rows grouped by its keys, which is a second scan of the key columns only.
"""

from __future__ import annotations

from contextlib import suppress
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, functions as F

from dayloom.functions.predicates import any_null, outside
from dayloom.operators.fingerprints import difference
from dayloom.operators.sizes import broadcast_if_small


class DataQualityError(Exception):
    """At least one check failed; ``report`` holds all rows of the report."""

    def __init__(self, report: list):
        self.report = report
        failed = [f"{r['check_name']}={r['violations']}" for r in report if r["status"] == "FAIL"]
        super().__init__("failed checks: " + ", ".join(failed))


@dataclass(frozen=True)
class RowCheck:
    """Counts rows for which ``violation`` is true; NULL is no violation."""

    name: str
    violation: Column = field(compare=False)


def not_null(name: str, *columns: str) -> RowCheck:
    return RowCheck(name, any_null(list(columns)))


def in_range(name: str, column: str, low: float | None = None, high: float | None = None,
             nan_violates: bool = False) -> RowCheck:
    return RowCheck(name, outside(F.col(column), low, high, nan_violates))


def non_negative(name: str, column: str) -> RowCheck:
    return in_range(name, column, low=0)


@dataclass(frozen=True)
class UniqueCheck:
    """Counts key groups that occur more than once (groups, not rows)."""

    name: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class ReconcileCheck:
    """Rows of the checked table against the sum of the summary's counts.

    ``days`` limits both sides to the same days, for tables whose other days were expired or
    not yet refreshed.
    """

    name: str
    summary: DataFrame = field(compare=False)
    count: str = "record_count"
    day: str | None = None
    days: tuple | None = None


@dataclass(frozen=True)
class MinRowsCheck:
    """One violation when the checked rows (of ``days``, if given) are fewer than ``least``."""

    name: str
    least: int = 4
    day: str | None = None
    days: tuple | None = None


Check = RowCheck | UniqueCheck | ReconcileCheck | MinRowsCheck


def _in_days(day: str | None, days: tuple | None) -> Column:
    return F.lit(True) if days is None else F.col(day).isin(list(days))


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups with more than one row, with their size. Copies are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def total(df: DataFrame, column: str, alias: str) -> DataFrame:
    """One row: the sum, 0 when there is nothing to sum."""
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).alias(alias))


def reconcile(facts: DataFrame, summary: DataFrame, count: str = "record_count") -> DataFrame:
    """One row ``(fact_rows, summary_rows)`` when the totals differ, none when they agree."""
    counted = facts.agg(F.count(F.lit(1)).alias("fact_rows"))
    return counted.crossJoin(total(summary, count, "summary_rows")).where(
        F.col("fact_rows") != F.col("summary_rows"))


def reconcile_landing(valid_records: DataFrame, facts: DataFrame, by: list[str]) -> DataFrame:
    """Per group of ``by`` that differs: valid landed records, fact rows, lost rows and surplus rows.

    Group by day and source file: rows lost in one never hide behind rows doubled in another.
    Groups that agree have no row. NULL is a group like any other.
    """
    landed = valid_records.groupBy(*by).agg(F.count(F.lit(1)).alias("landed_rows"), F.lit(0).cast("bigint").alias("fact_rows"))
    held = facts.groupBy(*by).agg(F.lit(0).cast("bigint").alias("landed_rows"), F.count(F.lit(1)).alias("fact_rows"))
    both = landed.unionByName(held).groupBy(*by).agg(
        F.sum("landed_rows").alias("landed_rows"), F.sum("fact_rows").alias("fact_rows"))
    gap = F.col("landed_rows") - F.col("fact_rows")
    zero = F.lit(0).cast("bigint")
    return both.where(gap != 0).select(*by, "landed_rows", "fact_rows", F.greatest(gap, zero).alias("lost_rows"),
                                       F.greatest(-gap, zero).alias("surplus_rows"))


def reconcile_rows(landed: DataFrame, facts: DataFrame, by: list[str]) -> DataFrame:
    """``reconcile_landing`` by the rows themselves: a row that has changed is one lost and one of surplus.

    Groups of ``by`` whose fingerprints agree on both sides are ruled out by two sums; only the rows of the others are
    counted one by one, over all columns the two have in common.
    """
    columns = [c for c in landed.columns if c in facts.columns]
    differs = broadcast_if_small(difference(landed, facts, by, columns).select(*(F.col(c).alias(f"_{c}") for c in by)))
    match = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    ours, theirs = (side.select(*columns).join(differs, match, "left_semi") for side in (landed, facts))
    both = ours.select(*columns, one.alias("landed_rows"), none.alias("fact_rows")).unionByName(
        theirs.select(*columns, none.alias("landed_rows"), one.alias("fact_rows")))
    counted = both.groupBy(*columns).agg(*(F.sum(c).alias(c) for c in ("landed_rows", "fact_rows")))
    gap = F.col("landed_rows") - F.col("fact_rows")
    return counted.groupBy(*by).agg(
        F.sum("landed_rows").alias("landed_rows"), F.sum("fact_rows").alias("fact_rows"),
        F.sum(F.greatest(gap, none)).alias("lost_rows"), F.sum(F.greatest(-gap, none)).alias("surplus_rows"))


def row_counts(checks: list[Check]) -> list[Column]:
    """What one pass over the rows has to count, ``c<n>`` for check n; a uniqueness check needs more than that."""
    counted = []
    for n, check in enumerate(checks):
        if isinstance(check, RowCheck):
            counted.append(F.count_if(check.violation).alias(f"c{n}"))
        elif isinstance(check, MinRowsCheck | ReconcileCheck):
            counted.append(F.count_if(_in_days(check.day, check.days)).alias(f"c{n}"))
    return counted


def report(facts: DataFrame, checks: list[Check]) -> DataFrame:
    """``(check_name, violations, status)``, one row per check, ordered by name."""
    names = [c.name for c in checks]
    if not checks or len(set(names)) != len(names):
        raise ValueError("give at least one check, each with a name of its own")
    scopes = {(getattr(c, "day", None), getattr(c, "days", None)) for c in checks}
    if len(scopes) == 1 and None not in next(iter(scopes)):
        facts = facts.where(_in_days(*next(iter(scopes))))  # all look at the same days: read no other partitions
    single_pass, violations, sides = row_counts(checks), {}, []
    for n, check in enumerate(checks):
        if isinstance(check, RowCheck):
            violations[check.name] = F.col(f"c{n}")
        elif isinstance(check, MinRowsCheck):
            violations[check.name] = F.when(F.col(f"c{n}") >= check.least, 0).otherwise(1)
        elif isinstance(check, ReconcileCheck):
            of_days = check.summary.where(_in_days(check.day, check.days))
            sides.append(total(of_days, check.count, f"s{n}"))
            violations[check.name] = F.abs(F.col(f"c{n}") - F.col(f"s{n}"))
    parts = []
    if single_pass:
        totals = reduce(DataFrame.crossJoin, sides, facts.agg(*single_pass))
        rows = [F.struct(F.lit(name).alias("check_name"), count.cast("bigint").alias("violations"))
                for name, count in violations.items()]
        parts.append(totals.select(F.inline(F.array(*rows))))
    for check in checks:
        if isinstance(check, UniqueCheck):
            parts.append(duplicate_groups(facts, list(check.keys)).agg(
                F.count(F.lit(1)).alias("violations"),
            ).select(F.lit(check.name).alias("check_name"), "violations"))
    status = F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    return reduce(DataFrame.unionAll, parts).withColumn("status", status).orderBy("check_name")


class Watch:
    """Row checks counted while the rows are written, so that the gate after a write does not read them again.

    The counts are taken in the tasks that write, behind every shuffle: a task that runs again counts once, as its files
    do. One watch belongs to one write.
    """

    def __init__(self, checks: list[Check]):
        self.checks = list(checks)
        self._seen: Observation | None = None

    def on(self, rows: DataFrame) -> DataFrame:
        """The rows, counted as the next action on them goes."""
        counted = row_counts(self.checks)
        if not counted:
            return rows
        self._seen = Observation()
        return rows.observe(self._seen, *counted)

    def counts(self) -> dict[str, int]:
        """What was counted; nothing where no row was written."""
        found = {f"c{n}": 0 for n, c in enumerate(self.checks) if not isinstance(c, UniqueCheck)}
        if self._seen is not None:
            with suppress(Py4JJavaError):  # a write without rows is planned away, and what watches it
                found.update(self._seen.get)
        return found

    def report(self, written: DataFrame, beside: DataFrame | None = None) -> list[Row]:
        """The rows of ``report`` for what was seen, and for ``beside``, rows checked along that were written earlier.

        ``written`` is all of it as it lies in the table; only the keys of uniqueness checks are read from it.
        """
        counts = self.counts()
        if beside is not None and counts:
            more = beside.agg(*row_counts(self.checks)).first()
            counts = {name: n + more[name] for name, n in counts.items()}
        sides = []
        for n, check in enumerate(self.checks):
            if isinstance(check, UniqueCheck):
                sides.append(duplicate_groups(written, list(check.keys)).agg(F.count(F.lit(1)).alias("n")))
            elif isinstance(check, ReconcileCheck):
                sides.append(total(check.summary.where(_in_days(check.day, check.days)), check.count, "n"))
        looked_up = [(n, c) for n, c in enumerate(self.checks) if isinstance(c, UniqueCheck | ReconcileCheck)]
        found = {}
        if sides:
            numbered = [s.select(F.lit(n).alias("check"), F.col("n").cast("bigint")) for (n, _), s in zip(looked_up, sides, strict=True)]
            found = {r["check"]: r["n"] for r in reduce(DataFrame.unionAll, numbered).collect()}
        rows = []
        for n, check in enumerate(self.checks):
            if isinstance(check, UniqueCheck):
                violations = found[n]
            elif isinstance(check, ReconcileCheck):
                violations = abs(counts[f"c{n}"] - found[n])
            elif isinstance(check, MinRowsCheck):
                violations = int(counts[f"c{n}"] < check.least)
            else:
                violations = counts[f"c{n}"]
            rows.append(Row(check_name=check.name, violations=violations, status="FAIL" if violations else "PASS"))
        return sorted(rows, key=lambda row: row.check_name)


def gate(checked: DataFrame | list) -> list:
    """Run a report and stop the job when any check fails. One row per check reaches the driver."""
    rows = checked if isinstance(checked, list) else checked.collect()
    if any(row["status"] == "FAIL" for row in rows):
        raise DataQualityError(rows)
    return rows


def warehouse_checks(summary: DataFrame, day: str | None = None, days: tuple | None = None) -> list[Check]:
    """The report card over a fact table and its summary; ``days`` limits what is reconciled."""
    # Check names and bounds.
    return [
        not_null("no_null_required", "observed_at", "ingested_at", "city"),
        UniqueCheck("no_duplicate_observation", ("observed_at", "city")),
        in_range("temperature_in_range", "temperature_c", -60, 60),
        in_range("humidity_in_range", "humidity_pct", 0, 100),
        non_negative("wind_speed_non_negative", "wind_speed_kmh"),
        ReconcileCheck("summary_reconciles_source", summary, day=day, days=days),
    ]


def model_checks() -> list[Check]:
    """The column and table tests on the fact table, run before the summary is rebuilt.

    These range tests are negated (``NOT x >= low``), so NaN violates them.
    """
    # Tested columns and bounds.
    return [
        not_null("not_null_observed_at", "observed_at"),
        not_null("not_null_city", "city"),
        not_null("not_null_temperature_c", "temperature_c"),
        in_range("accepted_range_temperature_c", "temperature_c", -60, 60, nan_violates=True),
        in_range("accepted_range_humidity_pct", "humidity_pct", 0, 100, nan_violates=True),
        in_range("accepted_range_wind_speed_kmh", "wind_speed_kmh", 0, nan_violates=True),
        UniqueCheck("unique_city_observed_at", ("city", "observed_at")),
    ]
