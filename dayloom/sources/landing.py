"""The landing zone: newline-delimited JSON below ``<root>/load_date=YYYY-MM-DD/``."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from dayloom.operators.sizes import gathered
from dayloom.schemas import Feed
from dayloom.session import remove_folder

FOLDER_DAY = "load_date"
CORRUPT = "_corrupt"
LONGEST_STRING = 2**31 - 1  # the decoder refuses longer strings; its default is 20 million characters


def _as_date(day: str | date) -> date:
    if isinstance(day, datetime):
        return day.date()
    return day if isinstance(day, date) else date.fromisoformat(day)


def day_paths(root: str, start: str | date, end: str | date) -> str:
    """A path that names the day folders of an inclusive range; folders that do not exist are skipped.

    Only the named folders are listed, so a read costs the same however many years lie beside them.
    """
    first, last = _as_date(start), _as_date(end)
    days = [(first + timedelta(n)).isoformat() for n in range((last - first).days + 1)]
    if len(days) == 1:
        return f"{root}/{FOLDER_DAY}={days[0]}"
    return f"{root}/{FOLDER_DAY}={{{','.join(days)}}}"


def _read_days(spark: SparkSession, root: str, schema: T.StructType, load,
               start, end, on_missing: str) -> DataFrame:
    """Read the day folders ``start..end``, either end open, through ``load(reader, paths)``.

    The folders that exist are listed by name and only those in the range are read. A range with
    none of them is an error or empty, as ``on_missing`` says, however long it is.
    """
    if on_missing not in ("fail", "empty"):
        raise ValueError("on_missing must be 'fail' or 'empty'")
    schema = T.StructType([*schema.fields, T.StructField(FOLDER_DAY, T.StringType())])
    paths = [root]
    if start is not None or end is not None:
        first = "" if start is None else _as_date(start).isoformat()
        last = "~" if end is None else _as_date(end).isoformat()
        paths = [f"{root}/{FOLDER_DAY}={day}" for day in landed_folders(spark, root) if first <= day <= last]
        if not paths:
            if on_missing == "empty" or first > last:
                return spark.createDataFrame([], schema)
            raise FileNotFoundError(f"PATH_NOT_FOUND: no day folder of {start or '...'} to {end or '...'} below {root}")
    try:
        return load(spark.read.schema(schema).option("basePath", root), paths)
    except AnalysisException as error:
        if on_missing == "empty" and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def landed_folders(spark: SparkSession, root: str) -> list[str]:
    """The days that have a folder below ``root``, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    found = path(root).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path(f"{root}/{FOLDER_DAY}=*"))
    return sorted(status.getPath().getName().split("=", 1)[1] for status in found or [])


def scan_ndjson(spark: SparkSession, root: str, feed: Feed, start: str | date | None = None,
                end: str | date | None = None, on_missing: str = "empty") -> DataFrame:
    """The landed records as a table of text columns plus the folder day, projected on read.

    Numbers keep their text, unknown keys are dropped, a line that is no JSON fills ``_corrupt``.
    This is the quick reader: it takes an array of objects for its objects and does not see text
    behind a record. ``parse_lines`` is the strict one.
    """
    schema = T.StructType([*feed.raw_schema().fields, T.StructField(CORRUPT, T.StringType())])
    return _read_days(
        spark, root, schema,
        lambda reader, paths: reader.option("columnNameOfCorruptRecord", CORRUPT).option("maxStringLen", LONGEST_STRING)
        .option("allowSingleQuotes", "false").json(paths),
        start, end, on_missing,
    )


def _source_file(lineage: str, pattern: str) -> Column:
    """Where a record came from: the real file, or the pattern the run was given."""
    if lineage == "file":
        return F.col("_metadata.file_path")
    if lineage == "pattern":
        return F.lit(pattern)
    raise ValueError("lineage must be 'file' or 'pattern'")


def not_blank(line: str = "line") -> Column:
    """The line holds more than white space; the first test settles all lines that are records."""
    text = F.col(line)
    return text.startswith("{") | text.rlike("\\S")


def scan_lines(spark: SparkSession, root: str, start: str | date | None = None,
               end: str | date | None = None, lineage: str = "file",
               on_missing: str = "empty") -> DataFrame:
    """The landed lines as they are: ``line, load_date, source_file``. Blank lines are no records."""
    pattern = f"{root}/*" if start is None or end is None else f"{day_paths(root, start, end)}/*"
    lines = _read_days(
        spark, root, T.StructType([T.StructField("line", T.StringType())]),
        lambda reader, paths: reader.text(paths).select(
            "line", FOLDER_DAY, _source_file(lineage, pattern).alias("source_file")),
        start, end, on_missing,
    )
    if "source_file" not in lines.columns:
        lines = lines.withColumn("source_file", F.lit(None).cast("string"))
    return lines.where(not_blank())


def scan_run_date(spark: SparkSession, root: str, run_date: str | date, lineage: str = "file",
                  on_missing: str = "fail") -> DataFrame:
    """The lines of one run date; a date without a folder fails unless told otherwise."""
    return scan_lines(spark, root, run_date, run_date, lineage, on_missing)


LINE_END = "end of line"  # field of the marker object that must directly follow a record


def parse_lines(lines: DataFrame, feed: Feed) -> DataFrame:
    """Decode one JSON object per line into text columns and a ``malformed`` flag.

    A line is one object and nothing else. Spark's JSON decoder stops after the first value, so
    text behind it would pass unseen. A line whose first closing brace is also its last character
    has nothing behind its object; any other line must decode as ``[<line>,<marker>]``. Decoding
    sits in a generator because filters are not pushed through one: each line is decoded once.
    """
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "maxStringLen": str(LONGEST_STRING)}
    record = T.StructType([*feed.raw_schema().fields, T.StructField(CORRUPT, T.StringType())])
    decoded = F.from_json("line", record, {**strict, "columnNameOfCorruptRecord": CORRUPT})
    mark = F.xxhash64("line")  # of the line itself, so that no line can bring its own marker
    marked = F.from_json(
        F.concat(F.lit("["), F.col("line"), F.lit(f',{{"{LINE_END}":'), mark.cast("string"), F.lit("}]")),
        T.ArrayType(T.StructType([T.StructField(LINE_END, T.LongType())])), strict,
    )
    ended = F.coalesce(F.get(marked, F.lit(1)).getField(LINE_END) == mark, F.lit(False))
    close = F.instr("line", "}")  # counted in characters; in plain ASCII the byte length spares counting them
    alone = F.when(close == F.octet_length("line"), True).when(close == F.length("line"), True).otherwise(ended)
    return (
        lines.select(*lines.columns, alone.alias("alone"))
        .select("*", F.inline(F.array(decoded)))
        .withColumn("malformed", F.col(CORRUPT).isNotNull() | ~F.col("alone"))
        .drop(CORRUPT, "alone")
    )


def land_ndjson(df: DataFrame, root: str, run_ts: datetime | None = None) -> dict:
    """Append ``df`` as NDJSON to the folder of the run's UTC day; reports folder and record count.

    NULL fields are written as ``null``. The count is observed while writing, in the task that
    commits the rows, so no second pass is needed.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(timezone.utc)
    day = run_ts.date().isoformat()
    counted = Observation()
    (
        df.observe(counted, F.count(F.lit(1)).alias("records"))
        .withColumn(FOLDER_DAY, F.lit(day))
        .write.partitionBy(FOLDER_DAY).mode("append").option("ignoreNullFields", "false").json(root)
    )
    return {"root": root, "folder": f"{FOLDER_DAY}={day}", "records": counted.get["records"]}


def land_by_day(df: DataFrame, root: str, day: str = FOLDER_DAY) -> None:
    """Backfill form of landing: each row goes to the folder of its own ``day`` column.

    Rows are gathered by day first so that every folder gets few files.
    """
    (
        gathered(df.withColumnRenamed(day, FOLDER_DAY), FOLDER_DAY)
        .write.partitionBy(FOLDER_DAY).mode("append").option("ignoreNullFields", "false").json(root)
    )


def expire_landing(spark: SparkSession, root: str, as_of: str | date, days: int = 7) -> list[str]:
    """Delete day folders up to ``days`` days before ``as_of``; returns the days removed."""
    oldest_kept = (_as_date(as_of) - timedelta(days - 1)).isoformat()
    old = [day for day in landed_folders(spark, root) if day < oldest_kept]
    for day in old:
        remove_folder(spark, f"{root}/{FOLDER_DAY}={day}")
    return old
