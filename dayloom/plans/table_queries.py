"""Registered queries: rollups, write modes, day filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dayloom.operators import rollup_state, tables
from dayloom.operators.ledger import Ledger
from dayloom.operators.rollup import (
    absent_days, daily_rollup, landed_days, min_rows, on_day, present_days, rows_per_day, with_day,
)
from dayloom.plans.bindings import OBSERVATIONS_SQL, observations
from dayloom.plans.registry import query, table
from dayloom.schemas import WEATHER
from dayloom.session import fresh_database

MEASURES = ["temperature_c", "humidity_pct", "wind_speed_kmh"]


def summary(facts: DataFrame, round_digits: int | None = None) -> DataFrame:
    return daily_rollup(facts, "load_date", ["city"], MEASURES, round_digits)


def summary_sql(source: str = "observations", digits: int | None = None, where: str = "TRUE") -> str:
    averages = ", ".join(
        (f"avg({m})" if digits is None else f"round(avg({m}), {digits})") + f" AS avg_{m}" for m in MEASURES)
    return (f"SELECT city, count(*) AS record_count, {averages}, load_date FROM {source} "
            f"WHERE {where} GROUP BY load_date, city")


@query("daily_summary", f"WITH {OBSERVATIONS_SQL} {summary_sql()}")
def daily_summary(spark, folder):
    """Records and averages per day and city."""
    return summary(observations(spark, folder))


@query("daily_summary_rounded", f"WITH {OBSERVATIONS_SQL} {summary_sql(digits=2)}")
def daily_summary_rounded(spark, folder):
    """The same with averages rounded to two digits."""
    return summary(observations(spark, folder), 2)


@query("daily_summary_lineitem", """SELECT l_returnflag, l_linestatus, count(*) AS record_count,
    avg(l_quantity) AS avg_l_quantity, avg(CAST(round(l_discount * 100) AS INTEGER)) AS avg_discount_pct,
    strftime(l_shipdate, '%Y-%m-%d') AS load_date
    FROM lineitem GROUP BY ALL""")
def daily_summary_lineitem(spark, folder):
    """The rollup at volume: line items per ship day, flag and status."""
    percent = F.round(F.col("l_discount") * 100).cast("int")
    items = with_day(table(spark, folder, "lineitem").withColumn("discount_pct", percent), "l_shipdate")
    return daily_rollup(items, "load_date", ["l_returnflag", "l_linestatus"], ["l_quantity", "discount_pct"])


@query("daily_summary_orders", """SELECT o_orderpriority, count(*) AS record_count,
    avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS avg_cents,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day
    FROM orders GROUP BY ALL""")
def daily_summary_orders(spark, folder):
    """The rollup by a DATE day; cents are whole numbers, so their sum is exact in any order."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    orders = with_day(table(spark, folder, "orders").select("o_orderpriority", cents, "o_orderdate"),
                      "o_orderdate", "order_day", "date")
    rollup = daily_rollup(orders, "order_day", ["o_orderpriority"], ["cents"])
    return rollup.withColumn("order_day", F.col("order_day").cast("string"))


@query("summary_by_sql", """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS observation_date, event_type AS city,
    count(*) AS record_count, round(avg(floor(value * 4) / 4), 2) AS avg_temperature_c,
    CASE WHEN max(floor(value * 4) / 4) > 300 THEN 'high' ELSE 'normal' END AS level,
    coalesce(sum(CASE WHEN event_type = 'error' THEN 1 END), 0)::BIGINT AS errors
    FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-15' GROUP BY ALL""")
def summary_by_sql(spark, folder):
    """The rollup in SQL over a view: grouping by ordinals, date literals, conditionals, final order."""
    observations(spark, folder).createOrReplaceTempView("observed")
    return spark.sql("""
        SELECT CAST(date(observed_at) AS STRING) AS observation_date, city, count(*) AS record_count,
               round(avg(temperature_c) * 100) / 100 AS avg_temperature_c,
               if(max(temperature_c) > 300, 'high', 'normal') AS level,
               ifnull(sum(CASE WHEN city = 'error' THEN 1 END), 0) AS errors
        FROM observed WHERE date(observed_at) <> DATE'2024-01-15' GROUP BY 1, 2 ORDER BY city, 1""")


@query("rows_per_day", """SELECT strftime(l_shipdate, '%Y-%m-%d') AS load_date, count(*) AS row_count
    FROM lineitem GROUP BY ALL""")
def rows_of_days(spark, folder):
    return rows_per_day(with_day(table(spark, folder, "lineitem"), "l_shipdate"), "load_date")


@query("landed_days", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS load_date FROM orders")
def days_of_orders(spark, folder):
    return landed_days(with_day(table(spark, folder, "orders"), "o_orderdate"), "load_date")


# ---- tables the write modes start from

EVENT_COLUMNS = ["event_id", "event_type", "value"]
EVENTS_SQL = "e AS (SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS load_date FROM events)"
SEED_END = "2024-01-10"
REFRESH_FROM = "2024-01-21"
RUN_DATE = "2024-01-15"


def daily_events(spark, folder) -> DataFrame:
    return with_day(table(spark, folder, "events"), "ts").select(*EVENT_COLUMNS, "load_date")


def event_table(spark, folder, rows: DataFrame | None = None) -> str:
    """A new day-partitioned table, with ``rows`` in it if given."""
    name = f"{fresh_database(spark, 'events')}.daily"
    tables.create_table(spark, name, daily_events(spark, folder).schema, "load_date")
    if rows is not None:
        tables.append(rows, name, cluster_by=["event_type"])
    return name


def summary_table(spark, rollup: DataFrame) -> str:
    name = f"{fresh_database(spark, 'summaries')}.daily_summary"
    tables.rebuild(rollup, name, "load_date", ["city"])
    return name


@query("append_twice", f"WITH {EVENTS_SQL} SELECT * FROM e UNION ALL SELECT * FROM e")
def append_twice(spark, folder):
    """Appending is not idempotent: the second run doubles the rows."""
    name = event_table(spark, folder)
    for _ in range(2):
        tables.append(daily_events(spark, folder), name, cluster_by=["event_type"])
    return spark.table(name)


@query("truncate_and_append", f"WITH {EVENTS_SQL} SELECT * FROM e")
def truncate_and_append(spark, folder):
    """Truncating keeps the table for the next append."""
    name = event_table(spark, folder, daily_events(spark, folder))
    tables.truncate(spark, name)
    tables.append(daily_events(spark, folder), name, cluster_by=["event_type"])
    return spark.table(name)


def seed_rows(spark, folder) -> DataFrame:
    """The first days without their errors."""
    return daily_events(spark, folder).where((F.col("load_date") <= SEED_END) & (F.col("event_type") != "error"))


def seeded(spark, folder) -> str:
    return event_table(spark, folder, seed_rows(spark, folder))


LATE = f"load_date <= '{SEED_END}' AND event_type = 'error'"


@query("append_new_days", f"WITH {EVENTS_SQL} SELECT * FROM e WHERE NOT ({LATE})")
def append_new_days(spark, folder):
    """All rows offered, twice: only days not landed are taken, late rows of landed days are not."""
    name = seeded(spark, folder)
    tables.append_new_days(daily_events(spark, folder), name)
    tables.append_new_days(daily_events(spark, folder), name, cluster_by=["event_type"])
    return spark.table(name)


@query("append_new_days_counts", f"""WITH {EVENTS_SQL}
    SELECT count(*) FILTER (load_date > '{SEED_END}') AS appended_rows,
           count(*) FILTER (load_date <= '{SEED_END}') AS skipped_rows FROM e""")
def append_new_days_counts(spark, folder):
    """How many rows the incremental append took and left."""
    landed = tables.append_new_days(daily_events(spark, folder), seeded(spark, folder))
    return spark.createDataFrame(
        [(landed.appended_rows, landed.skipped_rows)], "appended_rows bigint, skipped_rows bigint")


def with_ledger(spark, folder, rows: DataFrame | None = None) -> tuple[str, Ledger]:
    """A table of events whose ledger is kept by every write."""
    name = event_table(spark, folder)
    ledger = Ledger(spark, name).create()
    tables.append(seed_rows(spark, folder) if rows is None else rows, name, cluster_by=["event_type"], ledger=ledger)
    return name, ledger


@query("append_new_days_by_ledger", f"WITH {EVENTS_SQL} SELECT * FROM e WHERE NOT ({LATE})")
def append_new_days_by_ledger(spark, folder):
    """The same with the days at hand and the counts from the table's ledger: the table itself is not read."""
    name, ledger = with_ledger(spark, folder)
    for _ in range(2):
        tables.append_new_days(daily_events(spark, folder), name, cluster_by=["event_type"], ledger=ledger)
    return spark.table(name)


@query("ledger_of_days", f"""WITH {EVENTS_SQL} SELECT load_date, count(*) AS row_count, TRUE AS agrees FROM e
    WHERE NOT ({LATE}) AND load_date <> '{RUN_DATE}' AND CAST(load_date AS DATE) > DATE '2024-01-30' - 25 GROUP BY load_date""")
def ledger_of_days(spark, folder):
    """What the ledger says after appends, a date emptied, days replaced and days expired, against a count of the table."""
    name, ledger = with_ledger(spark, folder)
    events = daily_events(spark, folder)
    tables.append_new_days(events, name, cluster_by=["event_type"], ledger=ledger)
    tables.refresh_one_date(events.limit(0), name, "load_date", RUN_DATE, ledger=ledger)
    tables.refresh_dates_in_source(events.where(F.col("load_date") >= REFRESH_FROM), name, ledger=ledger)
    tables.expire(spark, name, "load_date", "2024-01-30", 25, ledger=ledger)
    counted = ledger.count()
    rows = [(day, held.rows, counted.get(day) == held) for day, held in ledger.days().items()]
    return spark.createDataFrame(rows, "load_date string, row_count bigint, agrees boolean")


@query("append_full_refresh", f"WITH {EVENTS_SQL} SELECT * FROM e")
def append_full_refresh(spark, folder):
    """The full refresh of the incremental table takes every row."""
    name = seeded(spark, folder)
    tables.append_new_days(daily_events(spark, folder), name, full_refresh=True, cluster_by=["event_type"])
    return spark.table(name)


@query("late_rows", f"WITH {EVENTS_SQL} SELECT * FROM e WHERE {LATE}")
def late_rows(spark, folder):
    """The rows the day skip would lose: all events are offered, those at hand are no late ones."""
    return tables.late_rows(daily_events(spark, folder), seeded(spark, folder))


@query("late_rows_by_type", f"WITH {EVENTS_SQL} SELECT * FROM e WHERE {LATE}")
def late_rows_by_type(spark, folder):
    """The same, looked for only among the types of a day whose fingerprints differ."""
    return tables.late_rows(daily_events(spark, folder), seeded(spark, folder), by=["event_type"])


def scaled(facts: DataFrame) -> DataFrame:
    """Observations whose temperature has changed since the summary was made."""
    return facts.withColumn("temperature_c", F.col("temperature_c") * 2)


SCALED_SQL = ("scaled AS (SELECT * REPLACE (temperature_c * 2 AS temperature_c) FROM observations)")


@query("refresh_dates_in_source", f"""WITH {OBSERVATIONS_SQL}, {SCALED_SQL}
    {summary_sql(where=f"load_date < '{REFRESH_FROM}'")}
    UNION ALL {summary_sql('scaled', where=f"load_date >= '{REFRESH_FROM}'")}""")
def refresh_dates_in_source(spark, folder):
    """Days in the source are replaced, the others keep their rows; running twice changes nothing."""
    name = summary_table(spark, summary(observations(spark, folder)))
    source = scaled(observations(spark, folder)).where(F.col("load_date") >= REFRESH_FROM)
    for _ in range(2):
        tables.refresh_dates_in_source(summary(source), name)
    return spark.table(name)


@query("refresh_one_date", f"""WITH {OBSERVATIONS_SQL}, {SCALED_SQL}
    {summary_sql(where=f"load_date <> '{RUN_DATE}'")}
    UNION ALL {summary_sql('scaled', where=f"load_date = '{RUN_DATE}'")}""")
def refresh_one_date(spark, folder):
    """One date is replaced."""
    name = summary_table(spark, summary(observations(spark, folder)))
    tables.refresh_one_date(summary(scaled(observations(spark, folder))), name, "load_date", RUN_DATE)
    return spark.table(name)


@query("refresh_one_date_empty", f"WITH {OBSERVATIONS_SQL} {summary_sql(where=f"load_date <> '{RUN_DATE}'")}")
def refresh_one_date_empty(spark, folder):
    """A date without source rows ends empty."""
    name = summary_table(spark, summary(observations(spark, folder)))
    source = observations(spark, folder).where(F.col("load_date") != RUN_DATE)
    tables.refresh_one_date(summary(source), name, "load_date", RUN_DATE)
    return spark.table(name)


@query("rebuild_summary", f"WITH {OBSERVATIONS_SQL}, {SCALED_SQL} {summary_sql('scaled')}")
def rebuild_summary(spark, folder):
    """The whole summary is made anew."""
    name = summary_table(spark, summary(observations(spark, folder)))
    tables.rebuild(summary(scaled(observations(spark, folder))), name, "load_date", ["city"])
    return spark.table(name)


@query("rollup_by_batches", f"WITH {OBSERVATIONS_SQL} {summary_sql(where="CAST(load_date AS DATE) > DATE '2024-01-30' - 20")}")
def rollup_by_batches(spark, folder):
    """The summary from mergeable sums: batches come late, in any order and twice; old days expire in between."""
    name = f"{fresh_database(spark, 'states')}.rollup"
    rollup_state.create_state(spark, name, WEATHER)
    rows = observations(spark, folder).withColumn("batch", F.when(F.col("city") == "error", 3).otherwise(F.minute("observed_at") % 3))
    for batch in (1, 3, 0, 1, 2):
        rollup_state.merge(spark, name, rows.where(F.col("batch") == batch).drop("batch"), f"batch {batch}", WEATHER)
        tables.expire(spark, name, "load_date", "2024-01-30" if batch == 2 else "2024-01-20", 20)
    return rollup_state.rollup_of(spark.table(name), WEATHER)


@query("expire_partitions", f"""WITH {EVENTS_SQL}
    SELECT * FROM e WHERE CAST(load_date AS DATE) > DATE '2024-01-30' - 7""")
def expire_partitions(spark, folder):
    """Partitions older than seven days are dropped."""
    name = event_table(spark, folder, daily_events(spark, folder))
    tables.expire(spark, name, "load_date", "2024-01-30", 7)
    return spark.table(name)


@query("within_retention", """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS load_date FROM orders
    WHERE CAST(o_orderdate AS DATE) > DATE '2000-06-30' - 365""")
def within_retention(spark, folder):
    """The retention rule as a filter."""
    orders = with_day(table(spark, folder, "orders"), "o_orderdate").select("o_orderkey", "load_date")
    return tables.within_retention(orders, "load_date", "2000-06-30", 365)


@query("one_date_of_table", f"WITH {EVENTS_SQL} SELECT * FROM e WHERE load_date = '{RUN_DATE}'")
def one_date_of_table(spark, folder):
    """A date filter on the partition column reads one folder."""
    name = event_table(spark, folder, daily_events(spark, folder))
    return on_day(spark.table(name), "load_date", RUN_DATE)


@query("clustered_table", f"""WITH {EVENTS_SQL}
    SELECT load_date, event_type, count(*) AS row_count FROM e GROUP BY ALL""")
def clustered_table(spark, folder):
    """A table gathered by day and ordered by type inside its files."""
    name = event_table(spark, folder, daily_events(spark, folder))
    return spark.table(name).groupBy("load_date", "event_type").agg(F.count(F.lit(1)).alias("row_count"))


ORDER_DAYS_SQL = """d AS (SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS load_date FROM orders),
    known AS (SELECT DISTINCT load_date FROM d WHERE load_date < '1996-01-01')"""


def order_days(spark, folder) -> tuple[DataFrame, DataFrame]:
    orders = with_day(table(spark, folder, "orders"), "o_orderdate").select(
        "o_orderkey", "o_orderstatus", "load_date")
    return orders, orders.where("load_date < '1996-01-01'")


@query("present_days_semi", f"WITH {ORDER_DAYS_SQL} SELECT * FROM d WHERE load_date IN (SELECT load_date FROM known)")
def present_days_semi(spark, folder):
    """Orders of days that are known already."""
    return present_days(*order_days(spark, folder), "load_date")


@query("missing_days_not_in",
       f"WITH {ORDER_DAYS_SQL} SELECT * FROM d WHERE load_date NOT IN (SELECT load_date FROM known)")
def missing_days_not_in(spark, folder):
    """Orders of days not known yet."""
    return absent_days(*order_days(spark, folder), "load_date")


@query("missing_days_anti", f"""WITH {ORDER_DAYS_SQL} SELECT d.* FROM d
    WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.load_date = d.load_date)""")
def missing_days_anti(spark, folder):
    """The same as a plain anti join, on days too many for a list."""
    return absent_days(*order_days(spark, folder), "load_date", null_aware=False, most=0)


@query("min_rows", """SELECT count(*) AS row_count, count(*) >= 4 AS enough FROM events
    WHERE strftime(ts, '%Y-%m-%d') = '2024-01-15'""")
def enough_rows(spark, folder):
    """The row threshold of one date."""
    return min_rows(on_day(daily_events(spark, folder), "load_date", RUN_DATE), 4)
