"""Fewer files for tables that are filled by day and batch.

Every batch of the ingest leaves a partition of its own in each day it meets, so a day has at least as many files as it
has had batches. Compaction lays runs of neighbouring batches together, as many as make up a target size, and writes each
run once, into the partition of its last batch; rows keep the number of the batch that took them. The newest batch of the table is
left alone, since it alone can run again. Files per day are then bounded by the day's bytes, whatever its batches.

A run is written before the partitions it replaces are dropped. If a writer dies in between, those rows are there
twice until the next compaction or ingest, which sees it by the rows themselves: a batch whose rows stand in the
partition of a later one has been replaced, and its own partition goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from dayloom.operators.sizes import broadcast_if_small, gathered
from dayloom.operators.tables import overwrite_partitions
from dayloom.session import staged

TARGET_BYTES = 128 * 1024 * 1024
DROPS_AT_ONCE = 200


def partition_columns(spark: SparkSession, table: str) -> tuple[str, str]:
    """The day and the batch column of a table partitioned by the two."""
    columns = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if len(columns) != 2:
        raise ValueError(f"{table} is not partitioned by day and batch")
    return columns[0], columns[1]


def partition_sizes(rows: DataFrame, day: str, batch: str) -> DataFrame:
    """``(day, batch, files, bytes)`` of the partitions; no column of the data is read."""
    files = rows.select(day, batch, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    one_each = files.groupBy(day, batch, "file").agg(F.max("size").alias("size"))
    return one_each.groupBy(day, batch).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def planned(sizes: DataFrame, day: str, batch: str, newest: int, target: int = TARGET_BYTES) -> DataFrame:
    """``(day, batch, into)`` of the partitions to rewrite: the runs of several batches.

    A run begins where the bytes before it pass a multiple of the target, so a day has at most one more run than
    its bytes fill targets, whatever its number of batches.
    """
    in_order = Window.partitionBy(day).orderBy(batch)
    before = F.coalesce(F.sum("bytes").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = sizes.where(F.col(batch) < newest).withColumn("run", F.floor(before / F.lit(target)))
    whole = Window.partitionBy(day, "run")
    grouped = runs.withColumn("into", F.max(batch).over(whole)).withColumn("members", F.count(F.lit(1)).over(whole))
    return grouped.where("members > 1").select(day, batch, "into")


def _drop(spark: SparkSession, table: str, day: str, batch: str, replaced: DataFrame) -> int:
    """Drop partitions, some at a time; their names alone reach the driver."""
    dropped, specs = 0, []

    def flush() -> None:
        if specs:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(specs))
            specs.clear()

    for row in replaced.select(F.col(day).cast("string").alias("d"), F.col(batch).alias("b")).toLocalIterator():
        named = "NULL" if row.d is None else f"'{row.d}'"
        specs.append(f"PARTITION (`{day}` = {named}, `{batch}` = {row.b})")
        dropped += 1
        if len(specs) >= DROPS_AT_ONCE:
            flush()
    flush()
    spark.catalog.refreshTable(table)
    return dropped


def replaced_partitions(rows: DataFrame, day: str, batch: str, taken_by: str) -> DataFrame:
    """Partitions whose rows stand in the partition of a later batch as well."""
    there = rows.select(day, batch, taken_by).distinct()
    moved = there.where(F.col(taken_by) < F.col(batch)).select(F.col(day).alias("_day"), F.col(taken_by).alias("_batch")).distinct()
    same = F.col(day).eqNullSafe(F.col("_day")) & (F.col(batch) == F.col("_batch"))
    return there.select(day, batch).distinct().join(broadcast_if_small(moved), same, "left_semi")


def finish_compaction(spark: SparkSession, table: str, taken_by: str = "taken_by") -> int:
    """Drop what a compaction that died has left beside its result; returns the number of partitions."""
    if taken_by not in spark.table(table).columns:
        return 0
    day, batch = partition_columns(spark, table)
    left = [tuple(r) for r in replaced_partitions(spark.table(table), day, batch, taken_by).limit(1).collect()]
    return _drop(spark, table, day, batch, replaced_partitions(spark.table(table), day, batch, taken_by)) if left else 0


def compact(spark: SparkSession, table: str, days: list | None = None, target: int = TARGET_BYTES,
            taken_by: str = "taken_by") -> int:
    """Lay small batches of each day, or of ``days``, together; returns the number of partitions that are gone."""
    finish_compaction(spark, table, taken_by)
    day, batch = partition_columns(spark, table)
    newest = spark.table(table).agg(F.max(batch)).first()[0]
    if newest is None:
        return 0
    rows = spark.table(table)
    rows = rows if days is None else rows.where(F.col(day).isin(list(days)))
    with staged(planned(partition_sizes(rows, day, batch), day, batch, newest, target).select(
            F.col(day).alias("_day"), F.col(batch).alias("_batch"), "into"), "compaction") as plan:
        if plan.isEmpty():
            return 0
        same = F.col(day).eqNullSafe(F.col("_day")) & (F.col(batch) == F.col("_batch"))
        moved = rows.join(broadcast_if_small(plan), same).withColumn(batch, F.col("into")).select(*rows.columns)
        overwrite_partitions(_together(moved, day, batch), table)
        return _drop(spark, table, day, batch, plan.where("_batch != into").select(
            F.col("_day").alias(day), F.col("_batch").alias(batch)))


def _together(rows: DataFrame, day: str, batch: str) -> DataFrame:
    """The rows of a partition in few tasks; a large one is split."""
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", day, batch)
    return gathered(rows, day)
