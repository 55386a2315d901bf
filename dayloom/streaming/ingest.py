"""Incremental ingest: every landed file is processed exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dayloom.functions.timestamps import day_of
from dayloom.operators import rollup_state
from dayloom.operators.compaction import finish_compaction
from dayloom.operators.tables import overwrite_partitions
from dayloom.operators.validate import accepted, classify, rejected
from dayloom.schemas import Feed
from dayloom.session import staged, use_utc
from dayloom.sources.landing import FOLDER_DAY, not_blank, parse_lines

OUTCOME = "outcome"  # first partition column of the target: accepted or rejected
FOLDER = "folder_day"


def _landed(spark: SparkSession, root: str, files_per_batch: int | None, bytes_per_batch: int | None) -> DataFrame:
    schema = T.StructType([T.StructField("line", T.StringType()), T.StructField(FOLDER_DAY, T.StringType())])
    # the source would pass over files dated 7 days before the newest; copies and restores keep their dates
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.text(root).select(
        "line", FOLDER_DAY, F.col("_metadata.file_path").alias("source_file")).where(not_blank())


def ingest_available(spark: SparkSession, root: str, path: str, checkpoint: str, feed: Feed,
                     files_per_batch: int | None = None, bytes_per_batch: int | None = None,
                     mode: str = "quarantine") -> None:
    """Process the files landed since the last call, then return.

    Each line is decoded once and goes to Parquet below ``path``, accepted rows by event-time
    day, rejected lines by folder day. Read them with ``ingested`` and ``ingest_rejects``, which
    follow the sink's commit log, so a batch that failed and ran again counts once. Late rows of
    an old day are taken like any others. Files are told apart, not readings: two files with the
    same reading give two rows, for the uniqueness check to find. A large backlog is best taken in
    batches, by number of files or by bytes: what a batch has committed is kept. The age of a file
    does not matter. The source remembers the path of every file that it has taken; ``expire_landing``
    shortens what it lists.
    """
    use_utc(spark)
    classified = classify(parse_lines(_landed(spark, root, files_per_batch, bytes_per_batch), feed), feed, mode)
    good = F.col("reason").isNull()
    day = F.when(good, day_of(F.col(feed.event_time), feed.day_type)).otherwise(
        F.col(FOLDER_DAY).cast(feed.day_field().dataType))
    rows = classified.select(
        *feed.names, "source_file", F.col(FOLDER_DAY).alias(FOLDER), "raw_line", "reason",
        F.when(good, "accepted").otherwise("rejected").alias(OUTCOME), day.alias(feed.day))
    (rows.writeStream.format("parquet").outputMode("append").partitionBy(OUTCOME, feed.day)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination())


def _taken(spark: SparkSession, path: str, feed: Feed, outcome: str) -> DataFrame:
    facts = feed.fact_schema()
    text = [T.StructField(name, T.StringType()) for name in (FOLDER, "raw_line", "reason", OUTCOME)]
    rows = spark.read.schema(T.StructType([*facts.fields[:-1], *text, facts.fields[-1]])).parquet(path)
    return rows.where(F.col(OUTCOME) == outcome)


def ingested(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """The accepted rows so far, in the layout of the fact table."""
    return _taken(spark, path, feed, "accepted").select(*feed.fact_schema().names)


def ingest_rejects(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """The rejected lines so far."""
    return _taken(spark, path, feed, "rejected").select(
        "source_file", F.col(FOLDER).alias(FOLDER_DAY), "raw_line", "reason")


BATCH = "batch_id"  # partition column below the day, in tables that the ingest fills
TAKEN_BY = "taken_by"  # the batch that took a row; compaction keeps it


def create_ingest_tables(spark: SparkSession, facts: str, rejects: str, feed: Feed) -> None:
    """Define the fact and reject tables that ``ingest_into_tables`` fills, by day and batch."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in feed.fact_schema().fields)
    spark.sql(f"CREATE TABLE {facts} ({fields}, {TAKEN_BY} bigint, {BATCH} bigint) USING parquet PARTITIONED BY (`{feed.day}`, {BATCH})")
    spark.sql(f"CREATE TABLE {rejects} (source_file string, raw_line string, reason string, {FOLDER_DAY} string, "
              f"{TAKEN_BY} bigint, {BATCH} bigint) USING parquet PARTITIONED BY ({FOLDER_DAY}, {BATCH})")


def ingest_into_tables(spark: SparkSession, root: str, facts: str, rejects: str, checkpoint: str, feed: Feed,
                       files_per_batch: int | None = None, bytes_per_batch: int | None = None,
                       mode: str = "quarantine", state: str | None = None) -> None:
    """Process the files landed since the last call into catalog tables, then return.

    Each batch is decoded once and overwrites its own partitions only, so a batch that runs again
    after a failure counts once, and no log beside the tables is needed: rollup, refresh, report,
    gate and expiry read and cut them like any other. One checkpoint belongs to one pair of tables.
    ``compact`` keeps the files of a day few. A ``state`` table takes each batch's sums, so that the summary
    of days with late rows needs no look at the facts; it takes a batch once, however often that runs.
    """
    use_utc(spark)
    for table in (facts, rejects):
        finish_compaction(spark, table)

    def fill(rows: DataFrame, table: str, batch: int) -> None:
        own = rows.withColumn(TAKEN_BY, F.lit(batch).cast("bigint")).withColumn(BATCH, F.lit(batch).cast("bigint"))
        overwrite_partitions(own, table)

    def take(lines: DataFrame, batch: int) -> None:
        # the query runs in a session of its own; what is written goes by the caller's
        with staged(classify(parse_lines(lines, feed), feed, mode), "batch") as once:
            fill(accepted(once, feed), facts, batch)
            fill(rejected(once), rejects, batch)
            if state:
                rollup_state.merge(spark, state, accepted(once, feed), f"batch {batch}", feed)

    (_landed(spark, root, files_per_batch, bytes_per_batch).writeStream.foreachBatch(take)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    for table in (facts, rejects, *([state] if state else [])):  # written by other sessions: this one has listed their files before
        spark.catalog.refreshTable(table)
