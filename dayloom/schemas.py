"""Feeds: which fields a record has, how they are typed, and how they roll up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "timestamp": T.TimestampType(),
}


# Columns the operators add beside the fields of a record.
RESERVED = ("line", "source_file", "malformed", "reason", "raw_line", "alone", "folder_day", "outcome")


@dataclass(frozen=True)
class Field:
    """One field of a landed record. ``completed`` timestamps get the UTC mark before the cast."""

    name: str
    type: str = "string"
    required: bool = False
    completed: bool = False


@dataclass(frozen=True)
class Feed:
    """A record layout with its event time, rollup keys and measures."""

    fields: tuple[Field, ...]
    event_time: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    day: str = "load_date"
    day_type: str = "string"

    def __post_init__(self) -> None:
        taken = [n for n in self.names if n in (*RESERVED, "load_date", self.day)]
        unknown = [f.name for f in self.fields if f.type not in TYPES]
        absent = [n for n in (self.event_time, *self.keys, *self.measures) if n not in self.names]
        if taken or unknown or absent or len(set(self.names)) != len(self.names):
            raise ValueError(f"names taken: {taken}; types unknown: {unknown}; no such field: {absent}; or a name twice")

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    def raw_schema(self) -> T.StructType:
        """Landed records are read with every field as text."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])

    def day_field(self) -> T.StructField:
        return T.StructField(self.day, T.DateType() if self.day_type == "date" else T.StringType())

    def fact_schema(self) -> T.StructType:
        """Typed fields, lineage, and the day key last, as partitioned tables need it.

        Nullability documents intent only: Parquet tables accept NULL in a NOT NULL column, so
        the required fields are checked when records are classified.
        """
        typed = [T.StructField(f.name, TYPES[f.type], not f.required) for f in self.fields]
        return T.StructType([*typed, T.StructField("source_file", T.StringType()), self.day_field()])

    def summary_schema(self) -> T.StructType:
        key_types = {f.name: TYPES[f.type] for f in self.fields}
        return T.StructType(
            [T.StructField(k, key_types[k], False) for k in self.keys]
            + [T.StructField("record_count", T.LongType(), False)]
            + [T.StructField(f"avg_{m}", T.DoubleType()) for m in self.measures]
            + [self.day_field()]
        )


WEATHER = Feed(
    fields=(
        Field("observed_at", "timestamp", required=True, completed=True),
        Field("ingested_at", "timestamp", required=True),
        Field("city", required=True),
        Field("country"),
        Field("latitude", "double"),
        Field("longitude", "double"),
        Field("temperature_c", "double"),
        Field("humidity_pct", "int"),
        Field("wind_speed_kmh", "double"),
    ),
    event_time="observed_at",
    keys=("city",),
    measures=("temperature_c", "humidity_pct", "wind_speed_kmh"),
)

# The cities observed, with country and position.
CITIES = [
    ("Vilnius", "Lithuania", 54.6872, 25.2797),
    ("Riga", "Latvia", 56.9496, 24.1052),
    ("Tallinn", "Estonia", 59.4370, 24.7536),
    ("Warsaw", "Poland", 52.2297, 21.0122),
]
PLACE_COLUMNS = ("city", "country", "latitude", "longitude")
