"""Nested API payloads flattened to landing records, and the small dimension they join."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayloom.functions.casts import to_type
from dayloom.operators.sizes import MOST_BROADCAST_ROWS, broadcast_if_small
from dayloom.schemas import CITIES, PLACE_COLUMNS
from dayloom.session import use_utc

# Payload field -> record field and type. ``time`` is mandatory, the rest optional.
CURRENT_FIELDS = {
    "temperature_2m": ("temperature_c", "double"),
    "relative_humidity_2m": ("humidity_pct", "int"),
    "wind_speed_10m": ("wind_speed_kmh", "double"),
}


def place_dimension(spark: SparkSession, places: list[tuple]) -> DataFrame:
    """A dimension of places given in code. Through Arrow it is a local relation of known size."""
    return spark.createDataFrame(pa.table(dict(zip(PLACE_COLUMNS, zip(*places)))))


def city_dimension(spark: SparkSession) -> DataFrame:
    return place_dimension(spark, CITIES)


def lookup(facts: DataFrame, dimension: DataFrame, key: str, how: str = "inner",
           most_rows: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """Attach dimension attributes by ``key``, which is unique in the dimension.

    The dimension is measured first and broadcast when small, so that no fact moves. A larger one
    is joined by shuffle, where adaptive execution splits keys that hold much of the facts.
    """
    return facts.join(broadcast_if_small(dimension, most_rows), key, how)


def utc_now(as_of: datetime | str | None) -> Column:
    """The processing-time stamp: now, or a fixed instant for repeatable runs."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def flatten_payload(payloads: DataFrame, dimension: DataFrame, key: str = "city",
                    payload: str = "payload", as_of: datetime | str | None = None,
                    mode: str = "strict") -> DataFrame:
    """``(key, payload JSON)`` to flat records; attributes come from the dimension, not the payload.

    ``strict`` fails the job on a payload without ``current.time``, with an unreadable number or
    of a key the dimension lacks; ``reject`` keeps such rows and names the fault in ``reason``.
    """
    if mode not in ("strict", "reject"):
        raise ValueError("mode must be 'strict' or 'reject'")
    use_utc(payloads.sparkSession)
    current = ", ".join(["time: string"] + [f"{name}: string" for name in CURRENT_FIELDS])
    decoded = F.from_json(payload, f"current struct<{current}>", {"maxStringLen": str(2**31 - 1)})
    parsed = lookup(
        payloads.select(key, F.explode(F.array(decoded)).alias("p")),
        dimension.withColumn("known", F.lit(True)), key, "left")
    faults = [F.when(F.col("known").isNull(), f"unknown:{key}"),
              F.when(F.col("p.current.time").isNull(), "missing:time")]
    values = []
    for source, (name, type_name) in CURRENT_FIELDS.items():
        text = F.col(f"p.current.{source}")
        value = to_type(text, type_name)
        values.append(value.alias(name))
        faults.append(F.when(text.isNotNull() & value.isNull(), f"invalid:{name}"))
    flat = parsed.select(
        F.col("p.current.time").alias("observed_at"),
        F.date_format(utc_now(as_of), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("ingested_at"),
        key, *[c for c in dimension.columns if c != key],
        *values, F.nullif(F.concat_ws(",", *faults), F.lit("")).alias("reason"),
    )
    if mode == "reject":
        return flat
    message = F.concat(F.lit("payload of "), F.col(key).cast("string"), F.lit(": "), F.col("reason"))
    sound = F.when(F.col("reason").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return flat.where(sound).drop("reason")  # a filter: it is evaluated whichever columns are used
