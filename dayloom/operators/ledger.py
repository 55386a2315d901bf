"""A ledger of what each day of a table holds: files, rows and a fingerprint of the rows.

It is a small table beside the one it describes, ``<table>_ledger``. A write enters that it has begun, writes, and
enters what the days it touched now hold, from their own files; so questions like "which days are there", "how many
rows" and "has this day changed" are answered without a scan of the facts. A write that dies leaves its beginning
without an end: the next one finds it and counts the days concerned again before anything is decided from them. Days
that the catalog has and the ledger lacks, as writes past the ledger leave them, are counted when they are met.

One writer at a time, as for the tables. Days reach the driver, which are as many as a calendar has.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dayloom.operators.fingerprints import fingerprints

SCHEMA = ("seq bigint, state string, day string, file_count bigint, row_count bigint, hash_a decimal(38,0), "
          "hash_b decimal(38,0)")
BEGUN, BEGUN_NEW, HOLDS, DONE = "begun", "begun new days", "holds", "done"
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
#: Writes after which the entries are folded into one per day.
FOLD_AFTER = 64


@dataclass(frozen=True)
class Held:
    """What a day holds."""

    files: int
    rows: int
    hash_a: Decimal = Decimal(0)
    hash_b: Decimal = Decimal(0)

    def same_rows(self, other: Held | None) -> bool:
        return other is not None and (self.rows, self.hash_a, self.hash_b) == (other.rows, other.hash_a, other.hash_b)


class Touched:
    """The days that a write has changed, as text; filled in by the writer."""

    def __init__(self) -> None:
        self.days: set[str] = set()

    def add(self, days: Iterable) -> None:
        self.days |= {NULL_DAY if d is None else str(d) for d in days}


@dataclass(frozen=True)
class Ledger:
    """The ledger of a day-partitioned table."""

    spark: SparkSession
    table: str
    day: str = "load_date"
    suffix: str = "_ledger"

    @property
    def name(self) -> str:
        return self.table + self.suffix

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def create(self) -> Ledger:
        """Define the ledger if there is none; what the table holds already is counted when it is first asked for."""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({SCHEMA}) USING parquet")
        return self

    def forget(self) -> None:
        """Drop all entries, before the table is made anew; its days are then counted when they are first asked for."""
        self.create()
        self.spark.sql(f"TRUNCATE TABLE {self.name}")

    # ---- asking

    def days(self) -> dict[str, Held]:
        """The days that have rows, with what they hold; every day is counted by now."""
        entries = self._read()
        entries = self._mended(entries) or entries
        held = self._latest(entries)
        missed = [d for d in self._catalog_days() if d not in held]
        if missed:
            self._enter(self._next(entries), missed)
            held = self._latest(self._read())
        return {d: h for d, h in held.items() if h.rows}

    def entered(self) -> dict[str, Held]:
        """The latest entry of each day as it stands, without a look at the table."""
        return self._latest(self._read())

    def typed(self, days: Iterable[str]) -> list:
        """Days of the ledger in the type of the table's column, without the day of NULL."""
        kind = self.spark.table(self.table).schema[self.day].dataType
        return [date.fromisoformat(d) if isinstance(kind, T.DateType) else d for d in sorted(days) if d != NULL_DAY]

    # ---- writing

    @contextmanager
    def writing(self, new_days_only: bool = False, days: Iterable | None = None) -> Iterator[Touched]:
        """Around a write to the table: enters its beginning, and at the end what the days it has touched now hold.

        What is promised beforehand bounds what has to be counted after a crash: ``new_days_only`` leaves alone the days
        that the table has, ``days`` touches no others. Without a promise it is the table.
        """
        entries = self._read()
        entries = self._mended(entries) or entries
        seq = self._next(self._folded(entries))
        touched = Touched()
        touched.add(days or [])
        scope = sorted(touched.days) if days is not None else [None]
        self._put([(seq, BEGUN_NEW if new_days_only else BEGUN, d, None, None, None, None) for d in scope or [NULL_DAY]])
        yield touched
        self._enter(seq, sorted(touched.days))

    def enter(self, held: dict[str, Held]) -> None:
        """Enter what days hold as counted elsewhere: the ledger of a table derived from another, day by day."""
        seq = self._next(self._folded(self._read()))
        self._put([(seq, HOLDS, d, h.files, h.rows, h.hash_a, h.hash_b) for d, h in sorted(held.items())]
                  + [(seq, DONE, None, None, None, None, None)])

    # ---- counting

    def count(self, days: list[str] | None = None) -> dict[str, Held]:
        """What days hold, from their partitions; others are not read."""
        table = self.spark.table(self.table)
        columns = table.columns
        if days is not None:
            named = F.col(self.day).isin(self.typed(days))
            table = table.where(named | F.col(self.day).isNull() if NULL_DAY in days else named)
        by_file = fingerprints(table.withColumn("_file", F.col("_metadata.file_path")), [self.day, "_file"], columns)
        by_day = by_file.groupBy(self.day).agg(
            F.count(F.lit(1)), *(F.sum(c) for c in ("row_count", "hash_a", "hash_b")))
        return {NULL_DAY if r[0] is None else str(r[0]): Held(*r[1:]) for r in by_day.collect()}

    # ---- inside

    def _read(self) -> list:
        return self.entries().collect()

    def _put(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.insertInto(self.name)

    @staticmethod
    def _next(entries: list) -> int:
        return 1 + max((e.seq for e in entries), default=0)

    @staticmethod
    def _latest(entries: list) -> dict[str, Held]:
        held = {}
        for e in sorted((e for e in entries if e.state == HOLDS), key=lambda e: e.seq):
            held[e.day] = Held(e.file_count, e.row_count, e.hash_a, e.hash_b)
        return held

    def _enter(self, seq: int, days: list[str]) -> None:
        """Count days and enter them with the end of the write, in one file: all of it is seen or nothing."""
        counted = self.count(days) if days else {}
        none = Held(0, 0)
        rows = [(seq, HOLDS, d, h.files, h.rows, h.hash_a, h.hash_b) for d in days for h in [counted.get(d, none)]]
        self._put([*rows, (seq, DONE, None, None, None, None, None)])

    def _catalog_days(self) -> list[str]:
        prefix = f"{self.day}="
        found = (row[0].split("/")[0] for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect())
        return sorted({part[len(prefix):] for part in found})

    def _mended(self, entries: list) -> list | None:
        """The entries after days of writes that began and did not end are counted; None when there are none."""
        ended = {e.seq for e in entries if e.state == DONE}
        begun = [e for e in entries if e.state in (BEGUN, BEGUN_NEW) and e.seq not in ended]
        if not begun:
            return None
        # files may have landed without their partition being known to the catalog
        self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.table)
        latest, there = self._latest(entries), set(self._catalog_days())
        unknown = {d for d in there if d not in latest or not latest[d].rows}
        if any(e.state == BEGUN and e.day is None for e in begun):
            days = there | set(latest)
        else:
            days = unknown | {e.day for e in begun if e.day is not None}
        counted = self.count(sorted(days)) if days else {}
        none = Held(0, 0)
        seqs = {e.seq for e in begun}
        self._put([(max(seqs), HOLDS, d, h.files, h.rows, h.hash_a, h.hash_b) for d in sorted(days) for h in [counted.get(d, none)]]
                  + [(seq, DONE, None, None, None, None, None) for seq in seqs])
        return self._read()

    def _folded(self, entries: list) -> list:
        """After many writes one entry per day in place of all; if this dies half way the days are counted anew, as any
        unknown day is."""
        if len({e.seq for e in entries}) <= FOLD_AFTER:
            return entries
        seq = max(e.seq for e in entries)
        rows = [(seq, HOLDS, d, h.files, h.rows, h.hash_a, h.hash_b) for d, h in sorted(self._latest(entries).items())]
        self.spark.createDataFrame([*rows, (seq, DONE, None, None, None, None, None)], SCHEMA).coalesce(1).write.insertInto(
            self.name, overwrite=True)
        return self._read()
