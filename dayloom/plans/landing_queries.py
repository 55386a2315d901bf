"""Registered queries: landing zone, decoding, validation, payloads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from dayloom.functions.timestamps import day_of, run_stamp, to_milliseconds, utc_marked
from dayloom.operators.compaction import compact
from dayloom.operators.rollup import rows_per_day
from dayloom.operators.validate import accepted, classify, rejected, require
from dayloom.plans.bindings import (
    JUDGED_SQL, RAW_SQL, STAGED_SQL, landed_lines, raw_records, reading,
)
from dayloom.plans.registry import query, table
from dayloom.schemas import WEATHER
from dayloom.session import fresh_database, fresh_folder, written
from dayloom.sources import landing
from dayloom.sources.landing import FOLDER_DAY
from dayloom.sources.payloads import flatten_payload, lookup, place_dimension
from dayloom.streaming.ingest import (
    BATCH, TAKEN_BY, create_ingest_tables, ingest_available, ingest_into_tables, ingest_rejects, ingested,
)

SOME_DAY = "2024-01-15"
FROM_DAY, TO_DAY = "2024-01-10", "2024-01-19"


def text_of(name: str) -> Column:
    """An instant as text with microseconds, to compare across engines."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def sql_text_of(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


MEASURES = ["latitude", "longitude", "temperature_c", "humidity_pct", "wind_speed_kmh"]


def typed(rows: DataFrame) -> DataFrame:
    return rows.select(text_of("observed_at"), text_of("ingested_at"), "city", "country", *MEASURES, "load_date")


TYPED_SQL = (f"{sql_text_of('observed_at')}, {sql_text_of('ingested_at')}, city, country, "
             f"{', '.join(MEASURES)}, load_date")


def landed_records(spark, folder) -> str:
    """The records, decodable all, landed as NDJSON by day."""
    root = fresh_folder(spark, "landing")
    landing.land_by_day(raw_records(spark, folder).drop("k"), root)
    return root


@query("scan_ndjson", f"""WITH {RAW_SQL}
    SELECT observed_at, ingested_at, city, country, CAST(latitude AS VARCHAR) AS latitude,
           CAST(longitude AS VARCHAR) AS longitude, temperature_c, humidity_pct,
           CAST(wind_speed_kmh AS VARCHAR) AS wind_speed_kmh, load_date
    FROM raw_records""")
def scan_ndjson(spark, folder):
    """Land all events as NDJSON and read them back as text columns with the folder day."""
    return landing.scan_ndjson(spark, landed_records(spark, folder), WEATHER).drop(landing.CORRUPT)


@query("scan_day_range", f"""WITH {RAW_SQL}
    SELECT city, humidity_pct, load_date FROM raw_records
    WHERE load_date BETWEEN '{FROM_DAY}' AND '{TO_DAY}'""")
def scan_day_range(spark, folder):
    """Projected day folders: only those of the range are listed."""
    root = landed_records(spark, folder)
    return landing.scan_ndjson(spark, root, WEATHER, FROM_DAY, TO_DAY).select("city", "humidity_pct", "load_date")


@query("scan_one_date", f"""WITH {JUDGED_SQL}
    SELECT city, humidity_pct, k BETWEEN 12 AND 15 AS malformed, load_date
    FROM (SELECT * REPLACE (CASE WHEN k NOT BETWEEN 12 AND 15 THEN city END AS city,
                            CASE WHEN k NOT BETWEEN 12 AND 15 THEN humidity_pct END AS humidity_pct) FROM judged)
    WHERE load_date = '{SOME_DAY}'""")
def scan_one_date(spark, folder):
    """The lines of one run date, decoded."""
    lines = landing.scan_run_date(spark, landed_lines(spark, folder), SOME_DAY)
    decoded = landing.parse_lines(lines, WEATHER)
    known = [F.when(~F.col("malformed"), F.col(c)).alias(c) for c in ("city", "humidity_pct")]
    return decoded.select(*known, "malformed", "load_date")


@query("decode_lines", f"""WITH {JUDGED_SQL}
    SELECT load_date, reason = 'malformed' AND reason IS NOT NULL AS malformed, count(*) AS line_count
    FROM judged GROUP BY ALL""")
def decode_lines(spark, folder):
    """Lines that are one JSON object and lines that are not, per folder day."""
    decoded = landing.parse_lines(landing.scan_lines(spark, landed_lines(spark, folder)), WEATHER)
    return decoded.groupBy("load_date", "malformed").agg(F.count(F.lit(1)).alias("line_count"))


@query("lineage_per_file", f"""WITH {RAW_SQL}
    SELECT load_date, 'load_date=' || load_date AS source_folder, count(*) AS line_count
    FROM raw_records GROUP BY ALL""")
def lineage_per_file(spark, folder):
    """The lineage stamp of each line names a file in the folder of its day."""
    lines = landing.scan_lines(spark, landed_lines(spark, folder), lineage="file")
    named = F.regexp_extract("source_file", "/(load_date=[^/]+)/[^/]+$", 1)
    return lines.groupBy("load_date", named.alias("source_folder")).agg(F.count(F.lit(1)).alias("line_count"))


@query("lineage_pattern", f"""WITH {RAW_SQL}
    SELECT 'load_date={SOME_DAY}/*' AS pattern, count(*) AS line_count
    FROM raw_records WHERE load_date = '{SOME_DAY}'""")
def lineage_pattern(spark, folder):
    """The lineage stamp as the pattern of the run, the same for all its lines."""
    root = landed_lines(spark, folder)
    lines = landing.scan_run_date(spark, root, SOME_DAY, lineage="pattern")
    shown = F.replace("source_file", F.lit(f"{root}/"), F.lit(""))
    return lines.groupBy(shown.alias("pattern")).agg(F.count(F.lit(1)).alias("line_count"))


@query("validate_required", f"""WITH {RAW_SQL}
    SELECT observed_at, ingested_at, city, country, humidity_pct, load_date FROM raw_records
    WHERE observed_at <> '' AND ingested_at <> '' AND city <> ''""")
def validate_required(spark, folder):
    """Records whose required fields are present; a blank city passes."""
    records = raw_records(spark, folder)
    # behind a generator: filters are not pushed through it, so the records are made once
    kept = require(records.select(F.inline(F.array(F.struct(*records.columns)))), WEATHER.required)
    return kept.select("observed_at", "ingested_at", "city", "country", "humidity_pct", "load_date")


def judged(spark, folder, **options):
    lines = landing.scan_lines(spark, landed_lines(spark, folder))
    return classify(landing.parse_lines(lines, WEATHER), WEATHER, **options)


@query("reject_reasons", f"""WITH {JUDGED_SQL}
    SELECT load_date, reason, count(*) AS line_count FROM judged WHERE reason IS NOT NULL GROUP BY ALL""")
def reject_reasons(spark, folder):
    """The reject log, counted by day and reason."""
    log = rejected(judged(spark, folder))
    return log.groupBy("load_date", "reason").agg(F.count("raw_line").alias("line_count"))


@query("typed_observations", f"WITH {STAGED_SQL} SELECT {TYPED_SQL} FROM staged")
def typed_observations(spark, folder):
    """Accepted lines, typed, with the event-time day as day key."""
    return typed(accepted(judged(spark, folder), WEATHER))


@query("typed_observations_milliseconds", f"""WITH {STAGED_SQL}
    SELECT strftime(date_trunc('millisecond', observed_at), '%Y-%m-%d %H:%M:%S.%f') AS observed_at,
           strftime(date_trunc('millisecond', ingested_at), '%Y-%m-%d %H:%M:%S.%f') AS ingested_at, city, country,
           latitude, longitude, temperature_c, humidity_pct, wind_speed_kmh, load_date
    FROM staged""")
def typed_observations_milliseconds(spark, folder):
    """The same with instants cut to three fractional digits."""
    rows = accepted(judged(spark, folder, milliseconds=True), WEATHER)
    return rows.select(text_of("observed_at"), text_of("ingested_at"), "city", "country", "latitude", "longitude",
                       "temperature_c", "humidity_pct", "wind_speed_kmh", "load_date")


@query("valid_and_rejected", f"""WITH {JUDGED_SQL}
    SELECT load_date, count(*) FILTER (reason IS NULL) AS valid_rows,
           count(*) FILTER (reason IS NOT NULL) AS rejected_rows
    FROM judged GROUP BY load_date""")
def valid_and_rejected(spark, folder):
    """Both outputs of one decoding: the classified records are written once and read twice."""
    once = written(judged(spark, folder), "classified")
    valid = once.where(F.col("reason").isNull()).groupBy("load_date").agg(F.count(F.lit(1)).alias("valid_rows"))
    faulty = rows_per_day(rejected(once), "load_date").withColumnRenamed("row_count", "rejected_rows")
    return valid.join(faulty, "load_date", "full").select(
        "load_date", F.coalesce("valid_rows", F.lit(0)).alias("valid_rows"),
        F.coalesce("rejected_rows", F.lit(0)).alias("rejected_rows"))


@query("normalize_timestamp", f"""WITH {JUDGED_SQL}
    SELECT observed_at AS given, marked_at AS tolerant,
           CASE WHEN strlen(observed_at) = 16 THEN observed_at || ':00Z' ELSE observed_at || 'Z' END AS always,
           CASE WHEN regexp_full_match(marked_at, '[0-9-]{{10}}T[0-9:]{{8}}Z')
                THEN replace(replace(marked_at, 'T', ' '), 'Z', '') END AS instant
    FROM judged""")
def normalize_timestamp(spark, folder):
    """Timestamp text under both completion rules, and the instant it stands for."""
    given = F.col("observed_at")
    instant = utc_marked(given).try_cast("timestamp")
    return raw_records(spark, folder).select(
        given.alias("given"), utc_marked(given).alias("tolerant"), utc_marked(given, "always").alias("always"),
        F.date_format(instant, "yyyy-MM-dd HH:mm:ss").alias("instant"))


@query("time_functions", """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day_date,
    strftime(ts, '%Y-%m-%d') AS day_text, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp,
    strftime(date_trunc('millisecond', ts), '%H:%M:%S.%f') AS milliseconds FROM events""")
def time_functions(spark, folder):
    """Day keys in both types, the run stamp, and the millisecond cut."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").select(
        "event_id", day_of(ts).cast("string").alias("day_date"), day_of(ts, "string").alias("day_text"),
        run_stamp(ts).alias("stamp"), F.date_format(to_milliseconds(ts), "HH:mm:ss.SSSSSS").alias("milliseconds"))


# Attributes of the event types: the inline dimension of the payload queries.
EVENT_TYPES = [("click", "web", 1.5, 10.25), ("view", "web", 2.5, 20.25), ("purchase", "shop", 3.5, 30.25),
               ("signup", "account", 4.5, 40.25), ("error", "system", 5.5, 50.25)]
EVENT_TYPES_SQL = "event_types(city, country, latitude, longitude) AS (VALUES {})".format(
    ", ".join(f"('{c}', '{g}', CAST({a} AS DOUBLE), CAST({o} AS DOUBLE))" for c, g, a, o in EVENT_TYPES))


def payloads(spark, folder):
    """``events`` as API payloads: some readings lack the time, some lack a metric."""
    k = reading()
    current = F.struct(
        F.when(k != 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.when(k != 2, F.col("value")).alias("temperature_2m"),
        F.when(k != 3, k).alias("relative_humidity_2m"),
        F.col("value").alias("wind_speed_10m"),
    )
    return table(spark, folder, "events").select(
        F.col("event_type").alias("city"),
        F.to_json(F.struct(F.lit(0.0).alias("latitude"), current.alias("current"))).alias("payload"))


FLAT_SQL = f"""WITH {EVENT_TYPES_SQL}, r AS (
      SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    SELECT CASE WHEN k <> 1 THEN strftime(ts, '%Y-%m-%dT%H:%M') END AS observed_at,
           '2026-07-12T07:44:07.000000+00:00' AS ingested_at, city, country, latitude, longitude,
           CASE WHEN k <> 2 THEN value END AS temperature_c, CASE WHEN k <> 3 THEN k END AS humidity_pct,
           value AS wind_speed_kmh, CASE WHEN k = 1 THEN 'missing:time' END AS reason
    FROM r JOIN event_types ON r.event_type = event_types.city"""


@query("flatten_payload", FLAT_SQL)
def flatten_payloads(spark, folder):
    """Payloads to flat records; a missing time is named, a missing metric is NULL."""
    return flatten_payload(
        payloads(spark, folder), place_dimension(spark, EVENT_TYPES), as_of="2026-07-12 07:44:07", mode="reject")


@query("land_flattened", f"""WITH flat AS ({FLAT_SQL})
    SELECT observed_at, city, country, CAST(latitude AS VARCHAR) AS latitude,
           CAST(temperature_c AS VARCHAR) AS temperature_c, CAST(humidity_pct AS VARCHAR) AS humidity_pct,
           '2026-07-12' AS load_date
    FROM flat WHERE reason IS NULL""")
def land_flattened(spark, folder):
    """Payloads flattened, landed as the NDJSON of one run, and read back."""
    flat = flatten_payloads(spark, folder)
    root = fresh_folder(spark, "landing")
    landing.land_ndjson(flat.where("reason IS NULL").drop("reason"), root, datetime(2026, 7, 12, 7, 44, 7))
    return landing.scan_ndjson(spark, root, WEATHER).select(
        "observed_at", "city", "country", "latitude", "temperature_c", "humidity_pct", "load_date")


@query("landing_count", """SELECT 'load_date=2026-07-12' AS folder, count(*) AS records FROM events""")
def landing_count(spark, folder):
    """What a landing run reports: its folder and how many records it wrote."""
    told = landing.land_ndjson(
        raw_records(spark, folder).drop("k", "load_date"), fresh_folder(spark, "landing"), datetime(2026, 7, 12))
    return spark.createDataFrame([(told["folder"], told["records"])], "folder string, records bigint")


@query("expire_landing", f"""WITH {RAW_SQL}
    SELECT load_date, count(*) AS row_count FROM raw_records
    WHERE CAST(load_date AS DATE) > DATE '2024-01-31' - 7 GROUP BY load_date""")
def expire_landing(spark, folder):
    """Landing folders older than seven days are deleted."""
    root = landed_records(spark, folder)
    landing.expire_landing(spark, root, "2024-01-31", 7)
    return rows_per_day(landing.scan_lines(spark, root), "load_date")


@query("dimension_lookup", """SELECT c_custkey, c_name, n_name, n_regionkey
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def dimension_lookup(spark, folder):
    """Attributes of a small dimension attached to facts."""
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return lookup(table(spark, folder, "customer"), nation, "c_nationkey").select(
        "c_custkey", "c_name", "n_name", "n_regionkey")


INGESTED_SQL = f"WITH {STAGED_SQL} SELECT {TYPED_SQL} FROM staged"


@query("ingest_available", INGESTED_SQL)
def ingest_twice(spark, folder):
    """Incremental ingest, called again without new files: every line once."""
    root = landed_lines(spark, folder)
    facts, log = fresh_folder(spark, "ingested"), fresh_folder(spark, "ingest-log")
    for _ in range(2):
        ingest_available(spark, root, facts, log, WEATHER)
    return typed(ingested(spark, facts, WEATHER))


@query("ingest_rejects", f"""WITH {JUDGED_SQL}
    SELECT load_date, reason, count(*) AS line_count FROM judged WHERE reason IS NOT NULL GROUP BY ALL""")
def ingest_reject_log(spark, folder):
    """The reject log of the incremental ingest."""
    target = fresh_folder(spark, "ingested")
    ingest_available(spark, landed_lines(spark, folder), target, fresh_folder(spark, "ingest-log"), WEATHER)
    log = ingest_rejects(spark, target, WEATHER)
    return log.groupBy(FOLDER_DAY, "reason").agg(F.count("raw_line").alias("line_count"))


@query("compacted_batches", f"""WITH {STAGED_SQL}
    SELECT load_date, count(*) AS row_count, max(humidity_pct) AS most_humid, TRUE AS few_partitions, TRUE AS batches_kept
    FROM staged GROUP BY load_date""")
def compacted_batches(spark, folder):
    """Tables filled by many small batches, compacted, and taken up by the ingest again: each row once, each day in few partitions."""
    facts, rejects = (f"{fresh_database(spark, 'ingested')}.{name}" for name in ("facts", "rejects"))
    create_ingest_tables(spark, facts, rejects, WEATHER)
    root, log = landed_lines(spark, folder), fresh_folder(spark, "ingest-log")
    before = None
    for _ in range(2):
        ingest_into_tables(spark, root, facts, rejects, log, WEATHER, files_per_batch=60)
        before = before or spark.table(facts).select(TAKEN_BY).distinct().count()
        compact(spark, facts)
    kept = spark.table(facts).select(TAKEN_BY).distinct().count() == before
    days = spark.table(facts).groupBy("load_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("humidity_pct").alias("most_humid"),
        (F.count_distinct(BATCH) <= 2).alias("few_partitions"))
    return days.withColumn("batches_kept", F.lit(kept))
