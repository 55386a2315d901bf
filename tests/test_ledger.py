"""The ledger of a table's days, fingerprints, and checks counted while rows are written."""

import os
import subprocess
import sys
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dayloom.operators import ledger as ledgers
from dayloom.operators import quality, tables
from dayloom.operators.fingerprints import difference, fingerprints
from dayloom.operators.ledger import Held, Ledger
from dayloom.plans import jobs
from plan_text import executed_plan, setting
from test_jobs import readings

COLUMNS = "city string, value double, load_date string"


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def four(spark, day, value=1.0):
    return rows_of(spark, *[(c, value, day) for c in ("Vilnius", "Riga", "Tallinn", "Warsaw")])


@pytest.fixture
def fact(spark, database):
    name = f"{database}.fact"
    tables.create_table(spark, name, rows_of(spark).schema, "load_date")
    return name


@pytest.fixture
def ledger(spark, fact):
    return Ledger(spark, fact).create()


def agrees(ledger):
    """The ledger says what a count of the whole table says."""
    assert ledger.days() == ledger.count()
    return {d: h.rows for d, h in ledger.days().items()}


def jobs_run(spark, action):
    """Number of Spark jobs that an action starts."""
    group = f"counted-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# ---- fingerprints

def test_equal_rows_have_equal_fingerprints_in_any_order(spark):
    rows = [("a", 1.0, "d"), ("a", 1.0, "d"), ("b", None, "d"), (None, float("nan"), "d"), ("c", -0.0, "e")]
    left = rows_of(spark, *rows).repartition(3)
    right = rows_of(spark, *[(c, 0.0 if v == 0 else v, d) for c, v, d in reversed(rows)])
    assert difference(left, right, ["load_date"]).collect() == []
    assert difference(left, right.select("load_date", "value", "city"), ["load_date"]).collect() == []


@pytest.mark.parametrize("other", [
    [("a", 1.0, "d")], [("a", 1.0, "d"), ("b", 1.0, "d")], [("a", 2.0, "d"), ("a", 1.0, "d")],
    [("a", None, "d"), ("a", 1.0, "d")], [(None, 1.0, "d"), ("a", 1.0, "d")], [("a", 1.0, "d"), ("a", 1.0, None)]])
def test_other_rows_have_others(spark, other):
    left, right = rows_of(spark, ("a", 1.0, "d"), ("a", 1.0, "d")), rows_of(spark, *other)
    assert difference(left, right, ["load_date"]).count() >= 1
    assert difference(right, left, ["load_date"]).count() >= 1


def test_nulls_and_nested_values_do_not_change_places(spark):
    pairs = spark.sql("SELECT 1 AS k, CAST(NULL AS int) AS a, 1 AS b, array(NULL, 1) AS c, named_struct('x', NULL, 'y', 2) AS s")
    turned = spark.sql("SELECT 1 AS k, 1 AS a, CAST(NULL AS int) AS b, array(1, NULL) AS c, named_struct('x', 2, 'y', NULL) AS s")
    assert difference(pairs.select("k", "a", "b"), turned.select("k", "a", "b"), ["k"]).count() == 1
    assert difference(pairs.select("k", "c"), turned.select("k", "c"), ["k"]).count() == 1
    assert fingerprints(pairs.select("k", "s"), ["k"]).first() != fingerprints(turned.select("k", "s"), ["k"]).first()


def test_a_fingerprint_moves_a_row_per_task_and_group(spark):
    plan = executed_plan(fingerprints(spark.range(1000).selectExpr("id % 3 AS g", "id"), ["g"]))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


# ---- the ledger

def test_every_write_mode_is_entered(spark, fact, ledger):
    tables.append(four(spark, "2026-07-10"), fact, ledger=ledger)
    tables.append(four(spark, "2026-07-10"), fact, cluster_by=["city"], ledger=ledger)
    assert agrees(ledger) == {"2026-07-10": 8}
    landed = tables.append_new_days(four(spark, "2026-07-10").union(four(spark, "2026-07-11")), fact, ledger=ledger)
    assert (landed.appended_rows, landed.skipped_rows, landed.new_days) == (4, 4, ("2026-07-11",))
    assert agrees(ledger) == {"2026-07-10": 8, "2026-07-11": 4}
    tables.refresh_dates_in_source(rows_of(spark, ("Riga", 9.0, "2026-07-11"), ("Riga", 9.0, "2026-07-12")), fact, ledger=ledger)
    assert agrees(ledger) == {"2026-07-10": 8, "2026-07-11": 1, "2026-07-12": 1}
    tables.refresh_one_date(rows_of(spark), fact, "load_date", "2026-07-12", ledger=ledger)
    assert agrees(ledger) == {"2026-07-10": 8, "2026-07-11": 1}
    assert tables.append_new_days(four(spark, "2026-07-12"), fact, ledger=ledger).appended_rows == 4
    assert tables.expire(spark, fact, "load_date", "2026-07-17", ledger=ledger) == ["2026-07-10"]
    assert agrees(ledger) == {"2026-07-11": 1, "2026-07-12": 4}
    tables.truncate(spark, fact, ledger=ledger)
    assert agrees(ledger) == {}
    assert ledger.days() == {} and tables.append_new_days(four(spark, "2026-07-11"), fact, ledger=ledger).appended_rows == 4


def test_files_are_counted_too(spark, fact, ledger):
    for _ in range(3):
        tables.append(four(spark, "2026-07-10").coalesce(1), fact, ledger=ledger)
    assert ledger.days()["2026-07-10"].files == 3


def test_a_full_refresh_and_the_first_run(spark, database):
    name = f"{database}.made"
    ledger = Ledger(spark, name).create()
    first = tables.append_new_days(four(spark, "2026-07-12"), name, ledger=ledger)
    assert (first.appended_rows, first.new_days) == (4, ("2026-07-12",))
    again = tables.append_new_days(four(spark, "2026-07-13"), name, full_refresh=True, ledger=ledger)
    assert (again.appended_rows, again.skipped_rows, again.new_days) == (4, 0, ("2026-07-13",))
    assert agrees(ledger) == {"2026-07-13": 4}


def test_a_null_day_and_date_days(spark, database):
    name = f"{database}.dated"
    dated = four(spark, "2026-07-12").union(rows_of(spark, ("x", 1.0, None))).withColumn("load_date", F.to_date("load_date"))
    ledger = Ledger(spark, name).create()
    tables.append_new_days(dated, name, ledger=ledger)
    assert agrees(ledger) == {"2026-07-12": 4, ledgers.NULL_DAY: 1}
    assert ledger.typed(ledger.days()) == [date(2026, 7, 12)]
    landed = tables.append_new_days(dated, name, ledger=ledger)  # NOT IN: beside a NULL day nothing is known to be absent
    assert (landed.appended_rows, landed.skipped_rows) == (0, 5)


def crashing(monkeypatch, at):
    """The next entry of the given kind is not made: the process has died just before it."""
    whole = Ledger._enter if at == "end" else None

    def die(self, seq, days):
        monkeypatch.setattr(Ledger, "_enter", whole)
        raise KeyboardInterrupt

    monkeypatch.setattr(Ledger, "_enter", die)


@pytest.mark.parametrize("write,rows", [
    (lambda s, t, g: tables.append(four(s, "2026-07-10"), t, ledger=g), {"2026-07-10": 8}),
    (lambda s, t, g: tables.append_new_days(four(s, "2026-07-11"), t, ledger=g), {"2026-07-10": 4, "2026-07-11": 4}),
    (lambda s, t, g: tables.refresh_dates_in_source(rows_of(s, ("a", 1.0, "2026-07-10")), t, ledger=g), {"2026-07-10": 1}),
    (lambda s, t, g: tables.refresh_one_date(rows_of(s), t, "load_date", "2026-07-10", ledger=g), {}),
    (lambda s, t, g: tables.expire(s, t, "load_date", "2026-08-10", ledger=g), {})])
def test_a_crash_between_a_write_and_its_entry_is_found_and_mended(spark, fact, ledger, monkeypatch, write, rows):
    tables.append(four(spark, "2026-07-10"), fact, ledger=ledger)
    crashing(monkeypatch, "end")
    with pytest.raises(KeyboardInterrupt):
        write(spark, fact, ledger)
    assert {e.state for e in ledger.entries().collect()} >= {ledgers.DONE}
    assert agrees(ledger) == rows
    late = tables.append_new_days(four(spark, "2026-07-10").union(four(spark, "2026-07-11")), fact, ledger=ledger)
    assert late.appended_rows == 4 * sum(d not in rows for d in ("2026-07-10", "2026-07-11"))


def test_a_crash_before_the_write_changes_nothing(spark, fact, ledger):
    tables.append(four(spark, "2026-07-10"), fact, ledger=ledger)
    with pytest.raises(Exception, match="no such row"):
        tables.append_new_days(four(spark, "2026-07-11").withColumn("value", F.raise_error(F.lit("no such row")).cast("double")),
                               fact, ledger=ledger)
    assert agrees(ledger) == {"2026-07-10": 4}
    assert tables.append_new_days(four(spark, "2026-07-11"), fact, ledger=ledger).appended_rows == 4


def test_files_that_the_catalog_does_not_know_are_found(spark, fact, ledger):
    """A writer that died after its files had landed and before the catalog heard of their partition."""
    seq = Ledger._next(ledger._read())
    ledger._put([(seq, ledgers.BEGUN_NEW, None, None, None, None, None)])
    where = spark.sql(f"DESCRIBE EXTENDED {fact}").where("col_name = 'Location'").first().data_type
    four(spark, "2026-07-10").select("city", "value").write.parquet(f"{where}/load_date=2026-07-10")
    landed = tables.append_new_days(four(spark, "2026-07-10"), fact, ledger=ledger)
    assert (landed.appended_rows, landed.skipped_rows) == (0, 4)
    assert spark.table(fact).count() == 4 and agrees(ledger) == {"2026-07-10": 4}


def test_writes_past_the_ledger_are_met(spark, fact, ledger):
    tables.append(four(spark, "2026-07-10"), fact)
    assert agrees(ledger) == {"2026-07-10": 4}
    tables.append(four(spark, "2026-07-11"), fact)
    assert tables.append_new_days(four(spark, "2026-07-11"), fact, ledger=ledger).appended_rows == 0


def test_entries_are_folded(spark, fact, ledger, monkeypatch):
    monkeypatch.setattr(ledgers, "FOLD_AFTER", 3)
    for n in range(1, 9):
        tables.append(four(spark, f"2026-07-0{1 + n % 4}"), fact, ledger=ledger)
    assert len({e.seq for e in ledger.entries().collect()}) <= 5
    assert agrees(ledger) == {f"2026-07-0{n}": 8 for n in range(1, 5)}
    ledger.spark.sql(f"TRUNCATE TABLE {ledger.name}")  # as a fold that died half way leaves it
    assert agrees(ledger) == {f"2026-07-0{n}": 8 for n in range(1, 5)}


@pytest.mark.parametrize("tracked", [True, False])
def test_jobs_do_not_grow_with_the_days_offered(spark, database, tracked):
    name = f"{database}.many"
    ledger = Ledger(spark, name).create() if tracked else None

    def days(n):
        return spark.range(n).selectExpr("id", "date_format(date_add(DATE'2026-01-01', cast(id AS int)), 'yyyy-MM-dd') AS load_date")

    tables.append_new_days(days(150), name, ledger=ledger)
    with setting(spark, "spark.sql.sources.parallelPartitionDiscovery.threshold", "1000"):  # else long lists of paths are a job
        few = jobs_run(spark, lambda: tables.append_new_days(days(60), name, ledger=ledger))
        many = jobs_run(spark, lambda: tables.append_new_days(days(150), name, ledger=ledger))
    assert many <= few + 1 and many < 15
    assert spark.table(name).count() == 150


def scans(spark, table, action):
    """How often the table's files are read by an action, from the plans it runs."""
    seen = []
    where = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first().data_type
    original = type(spark.table(table)).collect

    def collect(frame):
        seen.append(executed_plan(frame))
        return original(frame)

    patched = type(spark.table(table))
    patched.collect = collect
    try:
        action()
    finally:
        patched.collect = original
    return sum(where in plan or f"/{where.rsplit('/', 1)[1]}]" in plan for plan in seen), len(seen)


def test_stale_days_come_from_the_ledgers_without_a_scan(spark, database, tmp_path):
    lake = jobs.Lake(str(tmp_path / "raw"), f"{database}.observations", f"{database}.daily", cluster_by=("city",), ledger=True)
    jobs.land_ndjson(readings(spark), lake.root, datetime(2026, 7, 12, 7, 44))
    jobs.build_all(spark, lake)
    ledger = jobs.ledger_of(spark, lake)
    read, plans = scans(spark, lake.facts, lambda: jobs.stale_days(spark, lake, ledger, ledger.days()))
    assert read == 0 and plans >= 2
    assert scans(spark, lake.facts, ledger.count)[0] == 1  # the measure sees a scan where there is one


# ---- jobs with a ledger

@pytest.fixture
def lake(database, tmp_path):
    return jobs.Lake(str(tmp_path / "raw"), f"{database}.observations", f"{database}.daily", cluster_by=("city",), ledger=True)


def on(day, frame):
    return frame.withColumn("observed_at", F.lit(f"{day}T07:30"))


def test_incremental_builds_agree_with_whole_ones(spark, lake):
    for n, day in enumerate(("2026-07-12", "2026-07-13", "2026-07-13", "2026-07-14")):
        if n != 2:
            jobs.land_ndjson(on(day, readings(spark, temperature=20.0 + n)), lake.root, datetime.fromisoformat(day))
        landed, checks = jobs.build_all(spark, lake, only_new_days=True)
        assert landed.new_days == ((day,) if n != 2 else ())
        assert len(checks) == 8 and {r.status for r in checks} == {"PASS"}
        fresh = jobs.summarise(spark.table(lake.facts), lake.feed, 2)
        assert sorted(map(tuple, spark.table(lake.summary).collect())) == sorted(map(tuple, fresh.collect()))
    agrees(jobs.ledger_of(spark, lake))


def test_a_changed_row_makes_its_day_stale(spark, lake):
    """Row counts are the same before and after; the fingerprint is not."""
    jobs.land_ndjson(readings(spark), lake.root, datetime(2026, 7, 12, 7, 44))
    jobs.build_all(spark, lake, only_new_days=True)
    ledger = jobs.ledger_of(spark, lake)
    assert jobs.stale_days(spark, lake, ledger, ledger.days()) == []
    warmer = spark.table(lake.facts).withColumn("temperature_c", F.col("temperature_c") + 1)
    tables.refresh_dates_in_source(spark.createDataFrame(warmer.collect(), warmer.schema), lake.facts, ledger=ledger)
    assert jobs.stale_days(spark, lake, ledger, ledger.days()) == ["2026-07-12"]
    landed, _ = jobs.build_all(spark, lake, only_new_days=True)
    assert landed.appended_rows == 0
    assert {r.avg_temperature_c for r in spark.table(lake.summary).collect()} == {24.3}


def test_a_failed_gate_is_remembered_by_the_ledger(spark, lake):
    jobs.land_ndjson(readings(spark), lake.root, datetime(2026, 7, 12, 7, 44))
    jobs.build_all(spark, lake, only_new_days=True)
    jobs.land_ndjson(on("2026-07-13", readings(spark, temperature=75.0)), lake.root, datetime(2026, 7, 13, 7, 44))
    for _ in range(2):  # counted while written, then counted beside
        with pytest.raises(quality.DataQualityError, match="accepted_range_temperature_c=4"):
            jobs.build_all(spark, lake, only_new_days=True)
    assert spark.table(lake.summary).where("load_date = '2026-07-13'").count() == 0


def test_the_scheduled_run_takes_its_row_count_from_the_ledger(spark, lake):
    jobs.create_tables(spark, lake)
    jobs.run_daily(spark, lake, "2026-07-12", readings(spark))
    with pytest.raises(quality.DataQualityError, match="min_rows_of_day=1"):
        jobs.run_daily(spark, lake, "2026-07-12", least_rows=9)
    assert agrees(jobs.ledger_of(spark, lake)) == {"2026-07-12": 8}


# ---- checks while writing

def some_checks():
    return [quality.not_null("city", "city"), quality.in_range("value", "value", 0, 5), quality.MinRowsCheck("rows", 3),
            quality.MinRowsCheck("rows_of_day", 2, "load_date", ("2026-07-11",)), quality.UniqueCheck("once", ("city", "load_date"))]


@pytest.mark.parametrize("cluster_by", [None, ["city"]])
@pytest.mark.parametrize("rows", [
    [], [("a", 1.0, "2026-07-10")], [("a", 9.0, "2026-07-10"), (None, None, "2026-07-11"), ("b", 2.0, "2026-07-11"), ("b", -1.0, "2026-07-11")]])
def test_a_watched_write_reports_as_a_scan_does(spark, fact, rows, cluster_by):
    summary = spark.createDataFrame([(3, "2026-07-10")], "record_count long, load_date string")
    checks = [*some_checks(), quality.ReconcileCheck("summary", summary)]
    watch = quality.Watch(checks)
    tables.append(rows_of(spark, *rows), fact, cluster_by=cluster_by, watch=watch)
    table = spark.table(fact)
    assert list(map(tuple, watch.report(table))) == list(map(tuple, quality.report(table, checks).collect()))
    assert list(map(tuple, quality.Watch(checks).report(table, table))) == list(map(tuple, quality.report(table, checks).collect()))


def test_a_watched_write_reads_keys_only(spark, fact):
    watch = quality.Watch(some_checks())
    tables.append(four(spark, "2026-07-10"), fact, watch=watch)
    reads = scans(spark, fact, lambda: watch.report(spark.table(fact)))
    assert reads[0] <= 1


RETRIES = """
import sys, tempfile, os
sys.path[:0] = [{root!r}, {tests!r}]
from pyspark import TaskContext
from pyspark.sql import functions as F
from dayloom.operators import quality, tables
from dayloom.session import build_session, fresh_database
spark = build_session("retries", "local[2,4]", **{{"spark.sql.shuffle.partitions": "3", "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")}})
spark.sparkContext.setLogLevel("OFF")
marks = tempfile.mkdtemp(prefix="run-", dir="/tmp")
@F.udf("double")
def value(i):
    # the last row of each task fails the first time, after the others have been counted
    mark = os.path.join(marks, str(TaskContext.get().partitionId()))
    if i % 100 == 99 and not os.path.exists(mark):
        open(mark, "w").close()
        raise ValueError("first attempt")
    return float(i)
rows = spark.range(0, 400, 1, 4).select(F.lit("Riga").alias("city"), value("id").alias("value"), F.lit("2026-07-10").alias("load_date"))
name = fresh_database(spark, "retries") + ".fact"
tables.create_table(spark, name, rows.schema, "load_date")
watch = quality.Watch([quality.in_range("below", "value", low=1000), quality.MinRowsCheck("rows", 401)])
tables.append(rows, name, watch=watch)
print("COUNTED", watch.counts(), len(os.listdir(marks)), spark.table(name).count())
"""


def test_tasks_that_run_again_count_once():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = RETRIES.format(root=root, tests=os.path.join(root, "tests"))
    ran = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=240)
    assert "COUNTED {'c0': 400, 'c1': 400} 4 400" in ran.stdout, ran.stderr[-2000:]


def test_held_days_compare_by_rows_not_by_files():
    assert Held(1, 4).same_rows(Held(2, 4)) and not Held(1, 4).same_rows(Held(1, 5)) and not Held(1, 4).same_rows(None)
