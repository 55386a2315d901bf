"""Spreading rows over tasks, and measuring tables before they are sent to every task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

MOST_BROADCAST_ROWS = 500_000
MOST_BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def is_small(self, most_rows: int = MOST_BROADCAST_ROWS, most_bytes: int = MOST_BROADCAST_BYTES) -> bool:
        return self.rows <= most_rows and self.bytes <= most_bytes


def measured(df: DataFrame, most_rows: int = MOST_BROADCAST_ROWS) -> Size:
    """Rows and bytes of a table, counted up to ``most_rows`` + 1 rows."""
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    return Size(*df.limit(most_rows + 1).agg(F.count(F.lit(1)), size).first())


def is_small(df: DataFrame, most_rows: int = MOST_BROADCAST_ROWS, most_bytes: int = MOST_BROADCAST_BYTES) -> bool:
    """Whether a table is small enough to broadcast."""
    return measured(df, most_rows).is_small(most_rows, most_bytes)


def broadcast_if_small(df: DataFrame, most_rows: int = MOST_BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if is_small(df, most_rows) else df


def gathered(df: DataFrame, day: str) -> DataFrame:
    """Bring the rows of a day together, for few and well-filled files.

    ``rebalance`` lets adaptive execution split a day that holds much of the data over several
    tasks and merge small days; a plain repartition by day would make one task of the largest
    day. Without adaptive execution rows are dealt out evenly: more files, but no hot task.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", day)
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def clustered(df: DataFrame, day: str, cluster_by: list[str]) -> DataFrame:
    """Gather rows by day and order them, so that files have narrow min/max statistics."""
    return gathered(df, day).sortWithinPartitions(day, *cluster_by)
