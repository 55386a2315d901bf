"""Record validation: decoded lines to typed rows, with the faulty ones named and kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dayloom.functions.casts import to_type
from dayloom.functions.predicates import all_of, present
from dayloom.functions.timestamps import day_of, to_milliseconds, utc_marked
from dayloom.schemas import Feed, Field
from dayloom.session import use_utc


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows whose required fields are all present."""
    return df.where(all_of([present(F.col(c)) for c in columns]))


def _typed(field: Field, timestamp_rule: str, milliseconds: bool) -> Column:
    text = F.col(field.name)
    if field.completed:
        text = utc_marked(text, timestamp_rule)
    value = to_type(text, field.type)
    return to_milliseconds(value) if milliseconds and field.type == "timestamp" else value


def _faults(prefix: str, tests: list[tuple[str, Column]]) -> Column:
    """``prefix:a,prefix:b`` for the tests that hold, NULL when none does."""
    named = [F.when(test, f"{prefix}:{name}") for name, test in tests]
    return F.nullif(F.concat_ws(",", *named), F.lit("")) if named else F.lit(None).cast("string")


def classify(records: DataFrame, feed: Feed, mode: str = "quarantine",
             timestamp_rule: str = "tolerant", milliseconds: bool = False) -> DataFrame:
    """Type the records of ``parse_lines`` and state in ``reason`` why a record is not accepted.

    ``reason`` is NULL for accepted records, else ``malformed``, ``missing:<fields>`` or
    ``invalid:<fields>``; ``raw_line`` keeps the text of rejected records only. ``strict`` fails
    the job on the first value that cannot be typed instead of rejecting the record.
    """
    if mode not in ("quarantine", "strict"):
        raise ValueError("mode must be 'quarantine' or 'strict'")
    use_utc(records.sparkSession)
    raw = {f.name: f"raw_{f.name}" for f in feed.fields if f.type != "string" or f.required}
    typed = records.select(
        *[_typed(f, timestamp_rule, milliseconds).alias(f.name) for f in feed.fields],
        *[F.col(name).alias(alias) for name, alias in raw.items()],
        "source_file", "load_date", "line", "malformed",
    )
    missing = _faults("missing", [(c, ~present(F.col(raw[c]))) for c in feed.required])
    invalid = _faults("invalid", [
        (f.name, F.col(raw[f.name]).isNotNull() & F.col(f.name).isNull())
        for f in feed.fields if f.type != "string"
    ])
    if mode == "strict":
        invalid = F.when(invalid.isNotNull(), F.raise_error(
            F.concat(invalid, F.lit(" in "), F.col("line"))).cast("string"))
    reason = F.when(F.col("malformed"), "malformed").otherwise(F.coalesce(missing, invalid))
    # a filter on the reason must not pull the casts below: they would run twice for every record
    judged = typed.select(
        *feed.names, "source_file", "load_date", "line", F.inline(F.array(F.struct(reason.alias("reason")))))
    return judged.withColumn("raw_line", F.when(F.col("reason").isNotNull(), F.col("line"))).drop("line")


def accepted(classified: DataFrame, feed: Feed) -> DataFrame:
    """The typed rows of the fact table, the event-time day last."""
    return classified.where(F.col("reason").isNull()).select(
        *feed.names, "source_file",
        day_of(F.col(feed.event_time), feed.day_type).alias(feed.day),
    )


def rejected(classified: DataFrame) -> DataFrame:
    """The reject log: where it came from, the text, and the reason."""
    return classified.where(F.col("reason").isNotNull()).select(
        "source_file", "load_date", "raw_line", "reason")
