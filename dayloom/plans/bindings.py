"""The provided tables seen as the operators' inputs, in Spark and as the same rows in SQL.

``events`` plays the observations: ``event_type`` is the city, ``value`` in steps of a quarter the
temperature and the wind speed, ``props.k`` (0..99) the humidity. Sums of quarters are exact, so
averages do not depend on the order in which an engine adds. The landed text has faults that
``k`` decides on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayloom.operators.sizes import gathered
from dayloom.plans.registry import table
from dayloom.session import fresh_folder

INGEST_DELAY = "INTERVAL 20 MINUTE"  # readings late in the day land in the next day's folder


def reading(name: str = "props") -> Column:
    return F.get_json_object(name, "$.k").cast("int")


def quarters(name: str = "value") -> Column:
    return F.floor(F.col(name) * 4) / 4


QUARTERS_SQL = "floor(value * 4) / 4"


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as a typed fact table with the columns of the weather feed."""
    return table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("observed_at"),
        (F.col("ts") + F.expr(INGEST_DELAY)).cast("timestamp").alias("ingested_at"),
        F.col("event_type").alias("city"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("country"),
        (F.col("user_id") / 100).alias("latitude"),
        (F.col("event_id") / 100).alias("longitude"),
        quarters().alias("temperature_c"),
        reading().alias("humidity_pct"),
        quarters().alias("wind_speed_kmh"),
        F.lit("events").alias("source_file"),
        F.date_format("ts", "yyyy-MM-dd").alias("load_date"),
    )


OBSERVATIONS_SQL = f"""observations AS (
  SELECT ts AS observed_at, ts + INTERVAL 20 MINUTE AS ingested_at, event_type AS city,
         'user ' || CAST(user_id AS VARCHAR) AS country, user_id / 100.0 AS latitude,
         event_id / 100.0 AS longitude, {QUARTERS_SQL} AS temperature_c,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity_pct,
         {QUARTERS_SQL} AS wind_speed_kmh, strftime(ts, '%Y-%m-%d') AS load_date
  FROM events)"""


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as landed text records, faults included, with the folder day of their landing."""
    k, ts = F.col("k"), F.col("ts")
    landed_at = ts + F.expr(INGEST_DELAY)
    return table(spark, folder, "events").withColumn("k", reading()).select(
        F.when(k == 1, "")
        .when(k == 2, F.lit(None))
        .when(k == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm'+02:00'"))
        .when(F.col("event_type") == "click", F.date_format(ts, "yyyy-MM-dd'T'HH:mm"))
        .when(F.col("event_type") == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("observed_at"),
        F.when(k == 4, "yesterday").when(k == 5, "")
        .otherwise(F.date_format(landed_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")).alias("ingested_at"),
        F.when(k == 6, F.lit(None)).when(k == 7, "").when(k == 8, " ").otherwise(F.col("event_type")).alias("city"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("country"),
        (F.col("user_id") / 100).alias("latitude"),
        (F.col("event_id") / 100).alias("longitude"),
        F.when(k == 9, "n/a").otherwise(quarters().cast("string")).alias("temperature_c"),
        F.when(k == 10, "71.5").otherwise(k.cast("string")).alias("humidity_pct"),
        F.when(k != 11, quarters()).alias("wind_speed_kmh"),
        F.date_format(landed_at, "yyyy-MM-dd").alias("load_date"),
        "k",
    )


# The same records in SQL, how each is judged, and the typed rows of the accepted ones.
RAW_SQL = f"""raw_records AS (
  SELECT k, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN NULL
              WHEN k = 3 THEN strftime(ts, '%Y-%m-%dT%H:%M+02:00')
              WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M')
              WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS observed_at,
         CASE WHEN k = 4 THEN 'yesterday' WHEN k = 5 THEN ''
              ELSE strftime(landed_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS ingested_at,
         CASE WHEN k = 6 THEN NULL WHEN k = 7 THEN '' WHEN k = 8 THEN ' ' ELSE event_type END AS city,
         'user ' || CAST(user_id AS VARCHAR) AS country, user_id / 100.0 AS latitude,
         event_id / 100.0 AS longitude,
         CASE WHEN k = 9 THEN 'n/a' ELSE CAST({QUARTERS_SQL} AS VARCHAR) END AS temperature_c,
         CASE WHEN k = 10 THEN '71.5' ELSE CAST(k AS VARCHAR) END AS humidity_pct,
         CASE WHEN k <> 11 THEN {QUARTERS_SQL} END AS wind_speed_kmh,
         strftime(landed_at, '%Y-%m-%d') AS load_date
  FROM (SELECT *, ts + INTERVAL 20 MINUTE AS landed_at,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""
JUDGED_SQL = RAW_SQL + """, marked AS (
  SELECT *, CASE WHEN suffix(observed_at, 'Z') THEN observed_at
                 WHEN strlen(observed_at) = 16 THEN observed_at || ':00Z'
                 ELSE observed_at || 'Z' END AS marked_at,
         concat_ws(',', CASE WHEN coalesce(observed_at, '') = '' THEN 'missing:observed_at' END,
                        CASE WHEN coalesce(ingested_at, '') = '' THEN 'missing:ingested_at' END,
                        CASE WHEN coalesce(city, '') = '' THEN 'missing:city' END) AS missing
  FROM raw_records), judged AS (
  SELECT *, CASE WHEN k BETWEEN 12 AND 15 THEN 'malformed' WHEN missing <> '' THEN missing
    ELSE nullif(concat_ws(',',
      CASE WHEN NOT regexp_full_match(marked_at, '[0-9-]{10}T[0-9:]{8}Z') THEN 'invalid:observed_at' END,
      CASE WHEN ingested_at NOT LIKE '____-__-__T%' THEN 'invalid:ingested_at' END,
      CASE WHEN try_cast(temperature_c AS DOUBLE) IS NULL THEN 'invalid:temperature_c' END,
      CASE WHEN NOT regexp_full_match(humidity_pct, '[0-9]+') THEN 'invalid:humidity_pct' END), '') END AS reason
  FROM marked)"""
STAGED_SQL = JUDGED_SQL + """, staged AS (
  SELECT CAST(replace(replace(marked_at, 'T', ' '), 'Z', '') AS TIMESTAMP) AS observed_at,
         CAST(replace(left(ingested_at, 26), 'T', ' ') AS TIMESTAMP) AS ingested_at,
         city, country, latitude, longitude, CAST(temperature_c AS DOUBLE) AS temperature_c,
         CAST(humidity_pct AS INTEGER) AS humidity_pct, wind_speed_kmh, left(marked_at, 10) AS load_date,
         load_date AS folder_day
  FROM judged WHERE reason IS NULL)"""

# The same for the records as a collector hands them over: no line of theirs is malformed.
MALFORMED_SQL = "WHEN k BETWEEN 12 AND 15 THEN 'malformed' "
JUDGED_RECORDS_SQL, STAGED_RECORDS_SQL = (sql.replace(MALFORMED_SQL, "") for sql in (JUDGED_SQL, STAGED_SQL))


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The records as lines; some are cut short, followed by more text, or no object."""
    records = raw_records(spark, folder)
    whole = F.to_json(F.struct(*[c for c in records.columns if c not in ("k", "load_date")]))
    k = F.col("k")
    line = (
        F.when(k == 12, F.expr("left(whole, length(whole) - 7)"))
        .when(k == 13, F.concat("whole", F.lit(" and more")))
        .when(k == 14, F.concat("whole", "whole"))
        .when(k == 15, F.concat(F.lit("["), "whole", F.lit("]")))
        .otherwise(F.col("whole"))
    )
    return records.withColumn("whole", whole).select(line.alias("value"), "load_date")


def landed_lines(spark: SparkSession, folder: str) -> str:
    """Write the lines to a new landing zone, one folder per day; returns its root."""
    root = fresh_folder(spark, "landing")
    land_lines(raw_lines(spark, folder), root)
    return root


def land_lines(lines: DataFrame, root: str) -> None:
    gathered(lines, "load_date").write.partitionBy("load_date").mode("append").text(root)
