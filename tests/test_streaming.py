import os
import time

from dayloom.operators import quality
from dayloom.operators import tables
from dayloom.plans import jobs
from dayloom.streaming.ingest import (
    create_ingest_tables, ingest_available, ingest_into_tables, ingest_rejects, ingested,
)
from edge_lines import LINES, RIGA, write_folder


def test_a_batch_that_runs_again_counts_once(spark, tmp_path, weather):
    """The stream stops after the sink has committed a batch and before the checkpoint says so."""
    raw, out, log = (str(tmp_path / n) for n in ("raw", "facts", "log"))
    write_folder(tmp_path / "raw", "2026-07-12", [line for line, _ in LINES])
    ingest_available(spark, raw, out, log, weather, bytes_per_batch=1_000_000)
    for name in os.listdir(f"{log}/commits"):
        os.unlink(f"{log}/commits/{name}")
    ingest_available(spark, raw, out, log, weather)
    assert ingested(spark, out, weather).count() == 9
    assert ingest_rejects(spark, out, weather).count() == 12


def test_each_file_once_across_restarts(spark, tmp_path, weather):
    raw, out, log = (str(tmp_path / n) for n in ("raw", "facts", "log"))
    write_folder(tmp_path / "raw", "2026-07-12", [line for line, _ in LINES])

    def run():
        ingest_available(spark, raw, out, log, weather, files_per_batch=1)
        return ingested(spark, out, weather).count(), ingest_rejects(spark, out, weather).count()

    assert run() == (9, 12)
    assert run() == (9, 12)
    # a late file of an old day is taken, and a reading that comes twice stays visible
    write_folder(tmp_path / "raw", "2026-07-13", [RIGA], "late.json")
    write_folder(tmp_path / "raw", "2026-07-13", ["broken"], "broken.json")
    assert run() == (10, 13)
    rows = ingested(spark, out, weather)
    assert rows.where("source_file LIKE '%late.json'").first().load_date == "2026-07-12"
    assert quality.duplicate_groups(rows, ["city", "observed_at"]).first().copies == 3
    assert rows.schema.names == weather.fact_schema().names
    broken = ingest_rejects(spark, out, weather).where("raw_line = 'broken'").first()
    assert (broken.load_date, broken.reason) == ("2026-07-13", "malformed")


def test_files_of_any_age_are_taken(spark, tmp_path, weather):
    """A copy that keeps its date, a month before the newest file, is no older news."""
    raw, out, log = (str(tmp_path / n) for n in ("raw", "facts", "log"))
    write_folder(tmp_path / "raw", "2026-07-12", [RIGA], "new.json")
    ingest_available(spark, raw, out, log, weather)
    write_folder(tmp_path / "raw", "2026-07-12", [RIGA], "old.json")
    path = str(tmp_path / "raw" / "load_date=2026-07-12" / "old.json")
    os.utime(path, (time.time() - 30 * 86400,) * 2)
    ingest_available(spark, raw, out, log, weather)
    assert ingested(spark, out, weather).count() == 2


def test_ingest_fills_tables_that_the_jobs_work_on(spark, database, tmp_path, weather):
    lake = jobs.Lake(str(tmp_path / "raw"), f"{database}.facts", f"{database}.daily", f"{database}.rejects")
    log = str(tmp_path / "log")
    create_ingest_tables(spark, lake.facts, lake.rejects, weather)
    tables.create_table(spark, lake.summary, weather.summary_schema(), weather.day)
    write_folder(tmp_path / "raw", "2026-07-12", [line for line, _ in LINES])

    def run():
        ingest_into_tables(spark, lake.root, lake.facts, lake.rejects, log, weather, files_per_batch=1)
        return spark.table(lake.facts).count(), spark.table(lake.rejects).count()

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert run() == run() == (9, 12)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for name in os.listdir(f"{log}/commits"):  # the batch was written, the checkpoint does not say so
        os.unlink(f"{log}/commits/{name}")
    assert run() == (9, 12)
    write_folder(tmp_path / "raw", "2026-07-13", [RIGA], "late.json")
    assert run() == (10, 12)
    assert spark.table(lake.facts).where("source_file LIKE '%late.json'").first().load_date == "2026-07-12"
    jobs.refresh_summary(spark, lake)
    assert spark.table(lake.summary).agg({"record_count": "sum"}).first()[0] == 10
    report = {r.check_name: r.status for r in jobs.quality_report(spark, lake).collect()}
    assert report["summary_reconciles_source"] == "PASS"
    assert tables.expire(spark, lake.facts, weather.day, "2026-07-18", 7) == ["2026-07-11"]
    assert {r.load_date for r in spark.table(lake.facts).collect()} == {"2026-07-12"}
