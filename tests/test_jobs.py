from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dayloom.operators import quality, tables
from dayloom.operators.rollup import rows_per_day
from dayloom.plans import jobs
from dayloom.sources.payloads import city_dimension, flatten_payload
from dayloom.streaming.ingest import ingest_available, ingest_rejects, ingested
from edge_lines import LINES, RIGA, write_folder

DAY = "2026-07-12"


def readings(spark, clock="07:30", temperature=23.3):
    """One reading for each of the four cities, as the collector lands them."""
    payloads = city_dimension(spark).selectExpr(
        "city",
        f"""to_json(named_struct('current', named_struct('time', '{DAY}T{clock}', 'temperature_2m',
        {temperature}D, 'relative_humidity_2m', 71, 'wind_speed_10m', 5.0D))) AS payload""")
    return flatten_payload(payloads, city_dimension(spark), as_of=f"{DAY} 07:44:07.123456")


@pytest.fixture
def lake(spark, database, tmp_path):
    made = jobs.Lake(str(tmp_path / "raw"), f"{database}.observations", f"{database}.daily", f"{database}.rejects")
    jobs.create_tables(spark, made)
    return made


def test_one_run_of_four_cities(spark, lake):
    day = jobs.run_daily(spark, lake, DAY, readings(spark))
    assert sorted((r.city, r.record_count, r.avg_temperature_c, r.load_date) for r in day.collect()) == [
        (city, 1, 23.3, DAY) for city in ("Riga", "Tallinn", "Vilnius", "Warsaw")]
    fact = spark.table(lake.facts)
    assert {r.observed_at for r in fact.collect()} == {datetime(2026, 7, 12, 7, 30)}
    assert {r.ingested_at.microsecond for r in fact.collect()} == {123456}
    assert [tuple(r) for r in rows_per_day(fact, "load_date").collect()] == [(DAY, 4)]
    report = quality.gate(jobs.quality_report(spark, lake))
    assert [r.status for r in report] == ["PASS"] * 6


def test_five_runs_on_one_day_append_every_time(spark, lake):
    for n in range(5):
        jobs.land_ndjson(readings(spark), lake.root, datetime(2026, 7, 12, 8, n))
    jobs.load_run_date(spark, lake, DAY)
    assert spark.table(lake.facts).count() == 20
    jobs.refresh_summary(spark, lake, 2)
    jobs.refresh_summary(spark, lake, 2)
    assert [r.record_count for r in spark.table(lake.summary).collect()] == [5] * 4
    failed = {r.check_name: r.violations for r in jobs.quality_report(spark, lake).collect() if r.status == "FAIL"}
    assert failed == {"no_duplicate_observation": 4}
    jobs.load_run_date(spark, lake, DAY)
    assert spark.table(lake.facts).count() == 40
    tables.truncate(spark, lake.facts)
    assert spark.table(lake.facts).count() == 0


def test_edge_folder_end_to_end(spark, lake, tmp_path):
    write_folder(tmp_path / "raw", DAY, [line for line, _ in LINES])
    jobs.load_run_date(spark, lake, DAY)
    jobs.refresh_summary(spark, lake, 2)
    assert spark.table(lake.rejects).count() == 12
    got = {(r.load_date, r.city): (r.record_count, r.avg_temperature_c, r.avg_humidity_pct, r.avg_wind_speed_kmh)
           for r in spark.table(lake.summary).collect()}
    # Riga has its reading twice and one record without measures
    assert got[DAY, "Riga"] == (3, 23.3, 71.0, 5.0)
    assert got["2026-07-11", "Warsaw"] == (1, 18.0, 55.0, 2.0)
    assert got[DAY, "0"] == (1, None, None, None)
    report = {r.check_name: r.violations for r in jobs.quality_report(spark, lake).collect()}
    assert report == {"no_null_required": 0, "no_duplicate_observation": 1, "temperature_in_range": 1,
                      "humidity_in_range": 1, "wind_speed_non_negative": 1, "summary_reconciles_source": 0}


def test_refresh_and_report_of_some_days(spark, lake, tmp_path):
    write_folder(tmp_path / "raw", DAY, [line for line, _ in LINES])
    jobs.load_run_date(spark, lake, DAY)
    jobs.refresh_summary(spark, lake, days=["2026-07-11"])
    assert {r.load_date for r in spark.table(lake.summary).collect()} == {"2026-07-11"}
    assert [r.status for r in jobs.quality_report(spark, lake, days=["2026-07-11"]).collect()] == ["PASS"] * 6
    of_day = {r.check_name: r.violations for r in jobs.quality_report(spark, lake, days=[DAY]).collect()}
    assert of_day["summary_reconciles_source"] == 8 and of_day["temperature_in_range"] == 1


def test_gate_position(spark, lake):
    with pytest.raises(quality.DataQualityError, match="min_rows_of_day"):
        jobs.run_daily(spark, lake, DAY, readings(spark), least_rows=5, gate_at="before_summary")
    assert spark.table(lake.summary).count() == 0
    with pytest.raises(quality.DataQualityError):
        jobs.run_daily(spark, lake, DAY, least_rows=9)
    assert spark.table(lake.summary).count() == 4


def test_run_date_without_a_folder_fails(spark, lake, tmp_path):
    write_folder(tmp_path / "raw", DAY, [RIGA])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.run_daily(spark, lake, "2026-07-13")


@pytest.fixture
def models(database, tmp_path):
    return jobs.Lake(str(tmp_path / "raw"), f"{database}.observations", f"{database}.daily_summary",
                     cluster_by=("city",))


def test_build_all_passes_eight_checks_and_adds_nothing_twice(spark, models):
    jobs.land_ndjson(readings(spark), models.root, datetime(2026, 7, 12, 7, 44))
    landed, checks = jobs.build_all(spark, models)
    assert (landed.appended_rows, landed.skipped_rows) == (4, 0)
    assert [r.status for r in checks] == ["PASS"] * 8
    landed, _ = jobs.build_all(spark, models)
    assert (landed.appended_rows, landed.skipped_rows) == (0, 4)
    assert spark.table(models.summary).count() == 4


def test_late_file_is_skipped_until_full_refresh(spark, models):
    jobs.land_ndjson(readings(spark), models.root, datetime(2026, 7, 12, 7, 44))
    jobs.build_all(spark, models)
    jobs.land_ndjson(readings(spark, "08:30"), models.root, datetime(2026, 7, 12, 8, 44))
    landed, _ = jobs.build_all(spark, models)
    assert (landed.appended_rows, landed.skipped_rows) == (0, 8)  # four landed before, four late
    lost = jobs.lost_records(spark, models).collect()
    assert {r.load_date for r in lost} == {"2026-07-12"} and len({r.source_file for r in lost}) == len(lost)
    assert (sum(r.lost_rows for r in lost), sum(r.surplus_rows for r in lost)) == (4, 0)
    assert jobs.lost_records(spark, models, start="2026-07-13").collect() == []
    assert sum(r.lost_rows for r in jobs.lost_records(spark, models, "2026-07-12", "2026-07-12").collect()) == 4
    assert tables.late_rows(jobs.staging(spark, models), models.facts).count() == 4
    landed, _ = jobs.build_all(spark, models, full_refresh=True)
    assert landed.appended_rows == 8
    assert jobs.lost_records(spark, models).collect() == []
    assert tables.late_rows(jobs.staging(spark, models), models.facts).count() == 0


def test_a_failed_gate_is_remembered(spark, models):
    """The retry of a run whose test failed fails again, until the day is mended."""
    jobs.land_ndjson(readings(spark), models.root, datetime(2026, 7, 12, 7, 44))
    jobs.build_all(spark, models, only_new_days=True)
    bad = readings(spark, temperature=75.0).withColumn("observed_at", F.lit("2026-07-13T07:30"))
    jobs.land_ndjson(bad, models.root, datetime(2026, 7, 13, 7, 44))
    for _ in range(2):
        with pytest.raises(quality.DataQualityError, match="accepted_range_temperature_c=4"):
            jobs.build_all(spark, models, only_new_days=True)
    assert spark.table(models.summary).where("load_date = '2026-07-13'").count() == 0
    tables.refresh_one_date(spark.createDataFrame([], spark.table(models.facts).schema), models.facts, "load_date", "2026-07-13")
    jobs.build_all(spark, models, only_new_days=True, end="2026-07-12")
    assert spark.table(models.summary).count() == 4


def test_a_crash_after_the_append_is_made_up_for(spark, models):
    jobs.land_ndjson(readings(spark), models.root, datetime(2026, 7, 12, 7, 44))
    jobs.build_all(spark, models)
    jobs.land_ndjson(readings(spark).withColumn("observed_at", F.lit("2026-07-13T07:30")).withColumn(
        "observed_at", F.concat(F.lit("2026-07-13T0"), F.length("city").cast("string"), F.lit(":30"))), models.root, datetime(2026, 7, 13))
    tables.append_new_days(jobs.staging(spark, models), models.facts, cluster_by=["city"])
    landed, checks = jobs.build_all(spark, models, only_new_days=True)
    assert landed.new_days == () and {r.status for r in checks} == {"PASS"}
    assert spark.table(models.summary).where("load_date = '2026-07-13'").count() == 4


def test_days_that_fill_an_empty_partition_are_tested_too(spark, models):
    """A partition without rows, as a failed write leaves it, is filled by a second write, past what the first has counted."""
    jobs.land_ndjson(readings(spark), models.root, datetime(2026, 7, 12, 7, 44))
    jobs.build_all(spark, models)
    spark.sql(f"ALTER TABLE {models.facts} ADD PARTITION (load_date = '2026-07-13')")
    bad = readings(spark, temperature=75.0).withColumn("observed_at", F.lit("2026-07-13T07:30"))
    jobs.land_ndjson(bad, models.root, datetime(2026, 7, 13, 7, 44))
    with pytest.raises(quality.DataQualityError, match="accepted_range_temperature_c=4"):
        jobs.build_all(spark, models, only_new_days=True)


def test_only_new_days_gives_the_same_tables(spark, models, tmp_path):
    others = replace(models, facts=models.facts + "_full", summary=models.summary + "_full")
    for day in ("2026-07-12", "2026-07-13", "2026-07-13", "2026-07-14"):
        rows = readings(spark).withColumn("observed_at", F.lit(f"{day}T07:30"))
        if day == "2026-07-13":
            rows = rows.withColumn("observed_at", F.concat(F.lit(f"{day}T0"), F.length("city").cast("string"), F.lit(":30")))
        write = jobs.land_ndjson if not (tmp_path / "raw" / f"load_date={day}").exists() else None
        if write:
            write(rows, models.root, datetime.fromisoformat(day))
        landed, checks = jobs.build_all(spark, models, only_new_days=True)
        assert landed.new_days == ((day,) if write else ()) and {r.status for r in checks} == {"PASS"}
        jobs.build_all(spark, others)
        assert sorted(spark.table(models.summary).collect()) == sorted(spark.table(others.summary).collect())
    assert spark.table(models.facts).count() == 12


def test_failing_fact_test_leaves_the_summary(spark, models):
    jobs.land_ndjson(readings(spark), models.root, datetime(2026, 7, 12, 7, 44))
    jobs.build_all(spark, models)
    before = sorted(spark.table(models.summary).collect())
    jobs.land_ndjson(readings(spark, temperature=75.0), models.root, datetime(2026, 7, 12, 8, 44))
    with pytest.raises(quality.DataQualityError, match="accepted_range_temperature_c=4"):
        jobs.build_all(spark, models, full_refresh=True)
    assert sorted(spark.table(models.summary).collect()) == before


def test_staging_view(spark, models):
    jobs.land_ndjson(readings(spark), models.root, datetime(2026, 7, 12, 7, 44))
    jobs.staging(spark, models, view="staged")
    assert spark.sql("SELECT count(*) AS n FROM staged WHERE humidity_pct = 71").first().n == 4


def test_a_feed_with_date_days(spark, database, tmp_path, weather):
    """The warehouse layout: a DATE day key, lineage by pattern, unrounded script summary."""
    feed = replace(weather, day="observation_date", day_type="date")
    lake = jobs.Lake(str(tmp_path / "raw"), f"{database}.observations", f"{database}.daily", f"{database}.rejects",
                     feed=feed, lineage="pattern", cluster_by=("city",))
    write_folder(tmp_path / "raw", DAY, [line for line, _ in LINES])
    jobs.create_tables(spark, lake)
    day = jobs.run_daily(spark, lake, DAY)
    assert dict(spark.table(lake.facts).dtypes)["observation_date"] == "date"
    assert {r.observation_date for r in day.collect()} == {date(2026, 7, 12)} and day.count() == 6
    assert spark.table(lake.facts).where("observation_date = DATE'2026-07-11'").first().source_file.endswith(f"{DAY}/*")
    jobs.refresh_summary(spark, lake, days=[date(2026, 7, 11)])
    assert spark.table(lake.summary).count() == 7
    report = {r.check_name: r.violations for r in jobs.quality_report(spark, lake, days=[date(2026, 7, 12)]).collect()}
    assert report["summary_reconciles_source"] == 0 and report["no_duplicate_observation"] == 1
    models = replace(lake, facts=f"{database}.incremental", summary=f"{database}.incremental_daily")
    passing = [quality.not_null("city", "city")]
    landed, _ = jobs.build_all(spark, models, checks=passing)
    assert landed.new_days == (date(2026, 7, 11), date(2026, 7, 12))
    write_folder(tmp_path / "raw", "2026-07-13", [RIGA.replace("2026-07-12T07:30", "2026-07-13T07:30")])
    landed, _ = jobs.build_all(spark, models, checks=passing, only_new_days=True, start="2026-07-13")
    assert (landed.appended_rows, landed.skipped_rows, landed.new_days) == (1, 0, (date(2026, 7, 13),))
    assert spark.table(models.summary).count() == 8
    assert tables.expire(spark, models.facts, feed.day, "2026-07-19") == ["2026-07-11", "2026-07-12"]
    target = str(tmp_path / "ingested")
    ingest_available(spark, lake.root, target, f"{target}-log", feed)
    assert ingested(spark, target, feed).where("observation_date = DATE'2026-07-12'").count() == 8
    assert ingest_rejects(spark, target, feed).count() == 12
