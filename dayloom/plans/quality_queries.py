"""Registered queries: data-quality checks and the whole jobs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from dayloom.operators import quality, tables
from dayloom.operators.rollup import on_day
from dayloom.plans import jobs
from dayloom.plans.bindings import (
    JUDGED_RECORDS_SQL, OBSERVATIONS_SQL, STAGED_RECORDS_SQL, STAGED_SQL, land_lines, landed_lines, observations,
    raw_lines, raw_records,
)
from dayloom.plans.registry import query, table
from dayloom.plans.table_queries import RUN_DATE, summary, summary_sql
from dayloom.session import fresh_database, fresh_folder, staged
from dayloom.streaming import ingest

REPORT_SQL = "SELECT check_name, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM checks"


def checks_sql(source: str, **violations: str) -> str:
    """One row per check from aggregate expressions over ``source``."""
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, CAST({count} AS BIGINT) AS violations FROM {source}"
        for name, count in violations.items())
    return f"checks AS ({rows}) {REPORT_SQL}"


def beyond(column: str, low: float | None, high: float | None) -> str:
    sides = [f"{column} < {low}"] * (low is not None) + [f"{column} > {high}"] * (high is not None)
    return f"count(*) FILTER (WHERE {' OR '.join(sides)})"


def with_nulls(facts: DataFrame) -> DataFrame:
    """Observations that lack the temperature where the humidity is low, and some cities."""
    return facts.withColumn(
        "temperature_c", F.when(F.col("humidity_pct") > 5, F.col("temperature_c")),
    ).withColumn("city", F.when(F.col("humidity_pct") != 50, F.col("city")))


NULLS_SQL = """gappy AS (SELECT * REPLACE (CASE WHEN humidity_pct > 5 THEN temperature_c END AS temperature_c,
    CASE WHEN humidity_pct <> 50 THEN city END AS city) FROM observations)"""


@query("dq_not_null", f"WITH {OBSERVATIONS_SQL}, {NULLS_SQL}, " + checks_sql(
    "gappy",
    required="count(*) FILTER (WHERE observed_at IS NULL OR ingested_at IS NULL OR city IS NULL)",
    temperature="count(*) - count(temperature_c)"))
def dq_not_null(spark, folder):
    return quality.report(with_nulls(observations(spark, folder)), [
        quality.not_null("required", "observed_at", "ingested_at", "city"),
        quality.not_null("temperature", "temperature_c")])


MINUTES_SQL = "minutes AS (SELECT date_trunc('minute', ts) AS minute, event_type, user_id FROM events)"


def minutes(spark, folder) -> DataFrame:
    return table(spark, folder, "events").select(
        F.date_trunc("minute", "ts").alias("minute"), "event_type", "user_id")


@query("dq_unique", f"WITH {MINUTES_SQL}, " + checks_sql(
    "(SELECT minute, event_type, user_id FROM minutes GROUP BY ALL HAVING count(*) > 1)",
    one_event_a_minute="count(*)"))
def dq_unique(spark, folder):
    """Key groups that occur more than once."""
    return quality.report(minutes(spark, folder), [
        quality.UniqueCheck("one_event_a_minute", ("minute", "event_type", "user_id"))])


@query("duplicate_groups", f"""WITH {MINUTES_SQL}
    SELECT strftime(minute, '%Y-%m-%d %H:%M') AS minute, event_type, count(*) AS copies
    FROM minutes GROUP BY ALL HAVING count(*) > 1""")
def duplicate_groups(spark, folder):
    """The groups themselves, with their size."""
    groups = quality.duplicate_groups(minutes(spark, folder), ["minute", "event_type"])
    return groups.withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm"))


@query("dq_range", f"WITH {OBSERVATIONS_SQL}, {NULLS_SQL}, " + checks_sql(
    "gappy", temperature=beyond("temperature_c", -60, 60), humidity=beyond("humidity_pct", 0, 100),
    at_most=beyond("wind_speed_kmh", None, 100)))
def dq_range(spark, folder):
    """Inclusive ranges with both bounds or one; NULL passes."""
    return quality.report(with_nulls(observations(spark, folder)), [
        quality.in_range("temperature", "temperature_c", -60, 60),
        quality.in_range("humidity", "humidity_pct", 0, 100),
        quality.in_range("at_most", "wind_speed_kmh", high=100)])


@query("dq_range_lineitem", "WITH " + checks_sql(
    "lineitem", discount=beyond("l_discount", 0.02, 0.08), quantity=beyond("l_quantity", 1, 49),
    tax=beyond("l_tax", 0, None)))
def dq_range_lineitem(spark, folder):
    """Range checks at volume, in one scan."""
    return quality.report(table(spark, folder, "lineitem"), [
        quality.in_range("discount", "l_discount", 0.02, 0.08),
        quality.in_range("quantity", "l_quantity", 1, 49),
        quality.non_negative("tax", "l_tax")])


def partial_summary(spark, folder) -> DataFrame:
    """A summary that lacks the errors."""
    return summary(observations(spark, folder).where("city <> 'error'"))


TOTALS_SQL = """facts AS (SELECT count(*) AS fact_rows FROM observations),
    summed AS (SELECT CAST(sum(record_count) AS BIGINT) AS summary_rows FROM
      (SELECT load_date, city, count(*) AS record_count FROM observations WHERE city <> 'error' GROUP BY ALL))"""


@query("dq_reconcile", f"WITH {OBSERVATIONS_SQL}, {TOTALS_SQL}, " + checks_sql(
    "facts CROSS JOIN summed", summary_reconciles="abs(fact_rows - summary_rows)"))
def dq_reconcile(spark, folder):
    """Facts against the counts of a summary that is short of rows."""
    return quality.report(observations(spark, folder), [
        quality.ReconcileCheck("summary_reconciles", partial_summary(spark, folder))])


@query("dq_reconcile_days", f"WITH {OBSERVATIONS_SQL}, " + checks_sql(
    "observations", summary_reconciles=f"count(*) FILTER (WHERE city = 'error' AND load_date = '{RUN_DATE}')"))
def dq_reconcile_days(spark, folder):
    """The same limited to one day on both sides."""
    return quality.report(observations(spark, folder), [quality.ReconcileCheck(
        "summary_reconciles", partial_summary(spark, folder), day="load_date", days=(RUN_DATE,))])


@query("reconcile_cross_join", f"""WITH {OBSERVATIONS_SQL}, {TOTALS_SQL}
    SELECT fact_rows, summary_rows FROM facts CROSS JOIN summed WHERE fact_rows <> summary_rows""")
def reconcile_cross_join(spark, folder):
    """A row when the totals differ."""
    return quality.reconcile(observations(spark, folder), partial_summary(spark, folder))


@query("dq_min_rows", f"WITH {OBSERVATIONS_SQL}, " + checks_sql(
    "observations",
    four_on_the_day=f"CASE WHEN count(*) FILTER (WHERE load_date = '{RUN_DATE}') >= 4 THEN 0 ELSE 1 END",
    a_billion="CASE WHEN count(*) >= 1000000000 THEN 0 ELSE 1 END"))
def dq_min_rows(spark, folder):
    """Row thresholds, of one day and of the table."""
    return quality.report(observations(spark, folder), [
        quality.MinRowsCheck("four_on_the_day", 4, "load_date", (RUN_DATE,)),
        quality.MinRowsCheck("a_billion", 1_000_000_000)])


WAREHOUSE_SQL = dict(
    no_null_required="count(*) FILTER (WHERE observed_at IS NULL OR ingested_at IS NULL OR city IS NULL)",
    temperature_in_range=beyond("temperature_c", -60, 60),
    humidity_in_range=beyond("humidity_pct", 0, 100),
    wind_speed_non_negative=beyond("wind_speed_kmh", 0, None),
)


def duplicates_sql(source: str) -> str:
    return (f"(SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY observed_at, city HAVING count(*) > 1))")


@query("dq_report", f"WITH {OBSERVATIONS_SQL}, {NULLS_SQL}, " + checks_sql("gappy", **{
    **WAREHOUSE_SQL, "no_duplicate_observation": "any_value(" + duplicates_sql("gappy") + ")",
    "summary_reconciles_source": "count(*) FILTER (WHERE city = 'error')"}))
def dq_report(spark, folder):
    """The report card: six checks, two scans."""
    facts = with_nulls(observations(spark, folder))
    return quality.report(facts, quality.warehouse_checks(summary(facts.where("city IS NULL OR city <> 'error'"))))


@query("dq_report_while_writing", f"WITH {OBSERVATIONS_SQL}, {NULLS_SQL}, " + checks_sql("gappy", **{
    **WAREHOUSE_SQL, "no_duplicate_observation": "any_value(" + duplicates_sql("gappy") + ")",
    "summary_reconciles_source": "count(*) FILTER (WHERE city = 'error')"}))
def dq_report_while_writing(spark, folder):
    """The same report card counted by the append itself; only the keys of the uniqueness check are read again."""
    facts = with_nulls(observations(spark, folder))
    name = f"{fresh_database(spark, 'watched')}.facts"
    tables.create_table(spark, name, facts.schema, "load_date")
    watch = quality.Watch(quality.warehouse_checks(summary(facts.where("city IS NULL OR city <> 'error'"))))
    tables.append(facts, name, cluster_by=["city"], watch=watch)
    return spark.createDataFrame(watch.report(spark.table(name)), "check_name string, violations bigint, status string")


@query("dq_report_models", f"WITH {OBSERVATIONS_SQL}, {NULLS_SQL}, " + checks_sql(
    "gappy",
    not_null_observed_at="count(*) - count(observed_at)", not_null_city="count(*) - count(city)",
    not_null_temperature_c="count(*) - count(temperature_c)",
    accepted_range_temperature_c=beyond("temperature_c", -60, 60),
    accepted_range_humidity_pct=beyond("humidity_pct", 0, 100),
    accepted_range_wind_speed_kmh=beyond("wind_speed_kmh", 0, None),
    unique_city_observed_at="any_value(" + duplicates_sql("gappy") + ")"))
def dq_report_models(spark, folder):
    """The column and table tests of the fact table."""
    return quality.report(with_nulls(observations(spark, folder)), quality.model_checks())


@query("dq_gate", f"""WITH {OBSERVATIONS_SQL}
    SELECT 'temperature=' || count(*) FILTER (WHERE temperature_c > 60) AS failed FROM observations""")
def dq_gate(spark, folder):
    """The gate names the checks that failed."""
    checked = quality.report(observations(spark, folder), [
        quality.in_range("temperature", "temperature_c", -60, 60),
        quality.in_range("humidity", "humidity_pct", 0, 100)])
    try:
        quality.gate(checked)
    except quality.DataQualityError as error:
        failed = [f"{row.check_name}={row.violations}" for row in error.report if row.status == "FAIL"]
        return spark.createDataFrame([(name,) for name in failed], "failed string")
    return spark.createDataFrame([], "failed string")


@query("reconcile_landing", f"""WITH {STAGED_SQL}
    SELECT load_date, folder_day, count(*) AS landed_rows,
           count(*) FILTER (WHERE load_date > '2024-01-05' OR city <> 'error') + CAST(coalesce(sum(1) FILTER (WHERE load_date = '2024-01-08'), 0) AS BIGINT) AS fact_rows,
           count(*) FILTER (WHERE load_date <= '2024-01-05' AND city = 'error') AS lost_rows,
           count(*) FILTER (WHERE load_date = '2024-01-08') AS surplus_rows
    FROM staged GROUP BY load_date, folder_day HAVING lost_rows + surplus_rows > 0""")
def reconcile_landing(spark, folder):
    """Landed records that the facts lack or have twice, by day and folder: late rows left out, a day appended again."""
    lake = new_lake(spark, folder)
    staged = jobs.staging(spark, lake)
    early = (F.col("load_date") <= "2024-01-05") & (F.col("city") != "error")
    tables.append_new_days(staged.where(early), lake.facts, cluster_by=["city"])
    tables.append_new_days(staged, lake.facts, cluster_by=["city"])
    tables.append(staged.where("load_date = '2024-01-08'"), lake.facts)
    by_file = jobs.lost_records(spark, lake)
    folder_day = F.regexp_extract("source_file", "load_date=([^/]+)", 1).alias("folder_day")
    counts = ["landed_rows", "fact_rows", "lost_rows", "surplus_rows"]
    return by_file.groupBy("load_date", folder_day).agg(*(F.sum(c).alias(c) for c in counts))


@query("lost_records_changed", f"""WITH {STAGED_SQL}
    SELECT load_date, folder_day, count(*) AS landed_rows, count(*) AS fact_rows, count(*) FILTER (WHERE city = 'error') AS lost_rows,
           count(*) FILTER (WHERE city = 'error') AS surplus_rows
    FROM staged WHERE load_date = '2024-01-08' GROUP BY load_date, folder_day HAVING lost_rows > 0""")
def lost_records_changed(spark, folder):
    """Rows of one day that were changed in the facts: their number is as it was, their fingerprints are not."""
    lake = new_lake(spark, folder)
    staged = jobs.staging(spark, lake)
    warmer = F.when(F.col("city") == "error", F.coalesce("temperature_c", F.lit(0)) + 1).otherwise(F.col("temperature_c"))
    tables.append_new_days(staged, lake.facts, cluster_by=["city"])
    changed = staged.where("load_date = '2024-01-08'").withColumn("temperature_c", warmer)
    tables.refresh_dates_in_source(changed, lake.facts)
    folder_day = F.regexp_extract("source_file", "load_date=([^/]+)", 1).alias("folder_day")
    counts = ["landed_rows", "fact_rows", "lost_rows", "surplus_rows"]
    return jobs.lost_records(spark, lake).groupBy("load_date", folder_day).agg(*(F.sum(c).alias(c) for c in counts))


# ---- whole jobs

def new_lake(spark, folder, root: str | None = None, rejects: bool = False) -> jobs.Lake:
    database = fresh_database(spark, "lake")
    return jobs.Lake(
        root or landed_lines(spark, folder), f"{database}.facts", f"{database}.daily_summary",
        f"{database}.rejects" if rejects else None, cluster_by=("city",))


@query("staging_view", f"""WITH {STAGED_SQL}
    SELECT load_date, count(*) AS row_count, max(humidity_pct) AS most_humid FROM staged GROUP BY load_date""")
def staging_view(spark, folder):
    """The staging rows as a view that stores nothing, queried by SQL."""
    jobs.staging(spark, new_lake(spark, folder), view="staged_observations")
    return spark.sql("""SELECT load_date, count(*) AS row_count, max(humidity_pct) AS most_humid
                        FROM staged_observations GROUP BY load_date""")


@query("run_daily", f"WITH {STAGED_RECORDS_SQL} {summary_sql('staged', 2, where=f'''load_date = '{RUN_DATE}' ''')}")
def run_daily(spark, folder):
    """One scheduled run: land the records, append them, refresh the date, gate on its rows."""
    lake = new_lake(spark, folder, fresh_folder(spark, "landing"), rejects=True)
    jobs.create_tables(spark, lake)
    return jobs.run_daily(spark, lake, RUN_DATE, collected(spark, folder))


def collected(spark, folder) -> DataFrame:
    """The records as a collector hands them over."""
    return raw_records(spark, folder).drop("k", "load_date")


@query("run_daily_rejects", f"""WITH {JUDGED_RECORDS_SQL}
    SELECT reason, count(*) AS line_count FROM judged WHERE reason IS NOT NULL GROUP BY reason""")
def run_daily_rejects(spark, folder):
    """The reject table of a run."""
    lake = new_lake(spark, folder, fresh_folder(spark, "landing"), rejects=True)
    jobs.create_tables(spark, lake)
    jobs.run_daily(spark, lake, RUN_DATE, collected(spark, folder))
    return spark.table(lake.rejects).groupBy("reason").agg(F.count("raw_line").alias("line_count"))


def passing_checks() -> list[quality.Check]:
    """Fact tests that hold for the provided events."""
    return [
        quality.not_null("not_null_observed_at", "observed_at"),
        quality.not_null("not_null_city", "city"),
        quality.in_range("accepted_range_humidity_pct", "humidity_pct", 0, 100),
        quality.non_negative("accepted_range_wind_speed_kmh", "wind_speed_kmh"),
        quality.UniqueCheck("unique_longitude", ("longitude",)),
    ]


@query("build_all", f"WITH {STAGED_SQL} {summary_sql('staged', 2)}")
def build_all(spark, folder):
    """Staging, incremental facts, their tests, the rebuilt summary, its reconciliation; run twice."""
    lake = new_lake(spark, folder)
    for _ in range(2):
        jobs.build_all(spark, lake, checks=passing_checks())
    return spark.table(lake.summary)


@query("build_all_report", f"WITH {STAGED_SQL}, " + checks_sql("staged", **{
    name: "count(*) - count(*)" for name in (
        "not_null_observed_at", "not_null_city", "accepted_range_humidity_pct", "accepted_range_wind_speed_kmh",
        "unique_longitude", "summary_reconciles_source")}))
def build_all_report(spark, folder):
    """The reports of the same job: all checks pass."""
    _, rows = jobs.build_all(spark, new_lake(spark, folder), checks=passing_checks())
    return spark.createDataFrame(rows, "check_name string, violations bigint, status string")


CUT_DAY = "2024-01-15"


@query("build_all_in_two_steps", f"""WITH {STAGED_SQL}
    {summary_sql('staged', 2, where=f"folder_day <= '{CUT_DAY}' OR load_date > '{CUT_DAY}'")}""")
def build_all_in_two_steps(spark, folder):
    """Half of the folders, then the rest, of which only new days are tested and summarised.

    The readings of the last minutes of the cut day land in the next folder: they come late, and stay out.
    """
    lake, lines = new_lake(spark, folder, fresh_folder(spark, "landing")), raw_lines(spark, folder)
    land_lines(lines.where(F.col("load_date") <= CUT_DAY), lake.root)
    jobs.build_all(spark, lake, checks=passing_checks())
    land_lines(lines.where(F.col("load_date") > CUT_DAY), lake.root)
    jobs.build_all(spark, lake, checks=passing_checks(), only_new_days=True, start=CUT_DAY)
    return spark.table(lake.summary)


@query("build_all_by_ledger", f"""WITH {STAGED_SQL}, kept AS (
      SELECT * REPLACE (CASE WHEN load_date = '2024-01-08' THEN temperature_c + 1 ELSE temperature_c END AS temperature_c)
      FROM staged WHERE folder_day <= '{CUT_DAY}' OR load_date > '{CUT_DAY}')
    {summary_sql('kept', 2)}""")
def build_all_by_ledger(spark, folder):
    """The two steps with a ledger, and a third run that finds a day whose rows have changed in place."""
    lake = replace(new_lake(spark, folder, fresh_folder(spark, "landing")), ledger=True)
    lines = raw_lines(spark, folder)
    land_lines(lines.where(F.col("load_date") <= CUT_DAY), lake.root)
    jobs.build_all(spark, lake, checks=passing_checks(), only_new_days=True)
    land_lines(lines.where(F.col("load_date") > CUT_DAY), lake.root)
    jobs.build_all(spark, lake, checks=passing_checks(), only_new_days=True, start=CUT_DAY)
    with staged(spark.table(lake.facts).where("load_date = '2024-01-08'").withColumn(
            "temperature_c", F.col("temperature_c") + 1), "changed") as changed:
        tables.refresh_dates_in_source(changed, lake.facts, ledger=jobs.ledger_of(spark, lake))
    jobs.build_all(spark, lake, checks=passing_checks(), only_new_days=True, start=CUT_DAY)
    return spark.table(lake.summary)


@query("build_all_after_a_crash", f"WITH {STAGED_SQL} {summary_sql('staged', 2)}")
def build_all_after_a_crash(spark, folder):
    """A run that appended and died before the summary: the next one, of new days only, makes up for it."""
    lake = new_lake(spark, folder)
    jobs.create_tables(spark, lake)
    tables.append_new_days(jobs.staging(spark, lake), lake.facts, cluster_by=["city"])
    jobs.build_all(spark, lake, checks=passing_checks(), only_new_days=True)
    return spark.table(lake.summary)


@query("ingest_then_refresh", f"""WITH {STAGED_SQL}
    {summary_sql('staged', where="load_date > '2024-01-10'")}""")
def ingest_then_refresh(spark, folder):
    """The incremental ingest fills the tables in batches; expiry, refresh and report work on them."""
    lake = new_lake(spark, folder, rejects=True)
    tables.create_table(spark, lake.summary, lake.feed.summary_schema(), lake.feed.day)
    ingest.create_ingest_tables(spark, lake.facts, lake.rejects, lake.feed)
    log = fresh_folder(spark, "ingest-log")
    for _ in range(2):
        ingest.ingest_into_tables(spark, lake.root, lake.facts, lake.rejects, log, lake.feed, files_per_batch=40)
    tables.expire(spark, lake.facts, lake.feed.day, "2024-01-17")
    jobs.refresh_summary(spark, lake)
    quality.gate(quality.report(spark.table(lake.facts), passing_checks()))
    return spark.table(lake.summary)


@query("refresh_summary_of_days", f"""WITH {STAGED_SQL}
    {summary_sql('staged', where="load_date IN ('2024-01-03', '2024-01-04')")}""")
def refresh_summary_of_days(spark, folder):
    """The summary of two days, from their partitions alone."""
    lake = loaded(spark, folder)
    jobs.refresh_summary(spark, lake, days=["2024-01-03", "2024-01-04"])
    return spark.table(lake.summary)


def loaded(spark, folder) -> jobs.Lake:
    """Facts of every folder, and a summary table still empty."""
    lake = new_lake(spark, folder)
    jobs.create_tables(spark, lake)
    tables.append(jobs.staging(spark, lake), lake.facts, cluster_by=["city"])
    return lake


@query("refresh_summary", f"WITH {STAGED_SQL} {summary_sql('staged')}")
def refresh_summary(spark, folder):
    """The summary script, run twice."""
    lake = loaded(spark, folder)
    for _ in range(2):
        jobs.refresh_summary(spark, lake)
    return spark.table(lake.summary)


@query("quality_report", f"WITH {STAGED_SQL}, " + checks_sql("staged", **{
    **WAREHOUSE_SQL, "no_duplicate_observation": "any_value(" + duplicates_sql("staged") + ")",
    "summary_reconciles_source": f"count(*) FILTER (WHERE load_date <> '{RUN_DATE}')"}))
def quality_report(spark, folder):
    """The report script over the tables, when only one date has been summarised."""
    lake = loaded(spark, folder)
    rollup = jobs.summarise(on_day(spark.table(lake.facts), "load_date", RUN_DATE), lake.feed, None)
    tables.refresh_one_date(rollup, lake.summary, "load_date", RUN_DATE)
    return jobs.quality_report(spark, lake)
