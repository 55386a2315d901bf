"""What the physical plans must look like, and that hot groups are split."""

import glob

import pytest
from pyspark.sql import functions as F

from dayloom.operators import chat, tables
from dayloom.operators.rollup import absent_days, daily_rollup, on_day, present_days
from dayloom.operators.sizes import clustered
from dayloom.operators.validate import accepted, classify
from dayloom.plans import jobs
from dayloom.sources import landing
from edge_lines import RIGA, write_folder
from plan_text import executed_plan, setting

HOT = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def skewed(spark, rows=60_000):
    """Nine of ten rows fall on one day and one city."""
    hot = F.col("id") % 10 < 9
    return spark.range(rows).select(
        F.col("id").alias("reading"),
        F.when(hot, "Riga").otherwise(F.concat(F.lit("city "), (F.col("id") % 7).cast("string"))).alias("city"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
        F.when(hot, "2026-07-12").otherwise(F.concat(F.lit("2026-06-"), (F.col("id") % 9 + 10).cast("string")))
        .alias("load_date"),
    ).repartition(8)


def test_date_filter_prunes_partitions(spark, database):
    name = f"{database}.facts"
    tables.rebuild(skewed(spark, 1000), name, "load_date", ["city"])
    plan = executed_plan(on_day(spark.table(name), "load_date", "2026-07-12"))
    assert "(load_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    plan = executed_plan(present_days(spark.table(name), spark.sql("SELECT '2026-06-11' AS load_date"), "load_date"))
    assert "2026-06-11" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_landing_to_facts_is_one_stage_without_python(spark, tmp_path, weather):
    write_folder(tmp_path, "2026-07-12", [RIGA])
    lake = jobs.Lake(str(tmp_path), "facts", "summary")
    plan = executed_plan(jobs.staging(spark, lake))
    assert "Exchange" not in plan and "Python" not in plan and plan.count("Scan text") == 1
    # one decode of the record and one, for doubtful lines, of its end
    assert plan.count("from_json(StructField(observed_at") == 1


def test_rollup_reads_its_columns_and_combines_before_the_shuffle(spark, tmp_path):
    skewed(spark, 1000).withColumn("value", F.lit(1.0)).write.parquet(str(tmp_path / "t"))
    plan = executed_plan(daily_rollup(spark.read.parquet(str(tmp_path / "t")), "load_date", ["city"], ["value"]))
    assert plan.count("Exchange") == 1 and "partial_avg" in plan
    assert "ReadSchema: struct<city:string,load_date:string,value:double>" in plan


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_day_is_written_by_several_tasks(spark, tmp_path, adaptive):
    target = str(tmp_path / "t")
    with setting(spark, HOT, "256k"), setting(spark, "spark.sql.adaptive.enabled", adaptive):
        clustered(skewed(spark), "load_date", ["city"]).write.partitionBy("load_date").parquet(target)
    hot, others = glob.glob(f"{target}/load_date=2026-07-12/*.parquet"), glob.glob(f"{target}/load_date=2026-06-*/*.parquet")
    assert len(hot) >= 4
    if adaptive == "true":
        assert len(others) < 9 * 8
    assert spark.read.parquet(target).count() == 60_000
    per_file = spark.read.parquet(target).where("load_date = '2026-07-12'").groupBy(F.input_file_name()).count()
    assert max(r["count"] for r in per_file.collect()) < 54_000 / 2


def test_hot_conversation_is_spread_over_tasks(spark):
    turns = skewed(spark, 20_000).select(
        F.when(F.col("load_date") == "2026-07-12", 1).otherwise(F.col("reading") + 2).alias("conv_id"),
        F.col("reading").alias("turn"), F.lit("user").alias("role"), "text")
    messages = chat.build_messages(turns, max_bytes=100_000)
    sizes = messages.select("conv_id", "part", F.size("messages").alias("n"), F.octet_length(F.to_json("messages")).alias("b"))
    rows = sizes.collect()
    hot = [r for r in rows if r.conv_id == 1]
    assert sum(r.n for r in hot) == 18_000 and sum(r.n for r in rows) == 20_000
    assert len(hot) > 20 and max(r.b for r in hot) < 110_000


def test_refreshed_days_get_few_files(spark, database):
    """Rows are gathered by day: files do not grow with tasks times days."""
    name = f"{database}.daily"
    rows = spark.range(400).selectExpr("id", "concat('2026-', lpad(id % 12 + 1, 2, '0'), '-01') AS load_date").repartition(8)
    tables.rebuild(rows, name, "load_date")
    for _ in range(2):
        tables.refresh_dates_in_source(rows, name)
        assert spark.table(name).select(F.input_file_name()).distinct().count() <= 12
    tables.refresh_one_date(rows, name, "load_date", "2026-01-01")
    assert spark.table(name).where("load_date = '2026-01-01'").select(F.input_file_name()).distinct().count() == 1
    assert spark.table(name).count() == 400
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() == "static"


def test_many_absent_days_are_joined_without_a_broadcast(spark):
    rows, known = spark.range(50).selectExpr("id", "string(id) AS d"), spark.range(9).selectExpr("string(id) AS d")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        left = absent_days(rows, known, "d", most=3)
        assert left.count() == 41 and "BroadcastExchange" not in executed_plan(left)


def test_days_at_hand_come_from_the_catalog(spark, database):
    """A partition without rows is no day at hand, and of the others no data is read."""
    name = f"{database}.facts"
    tables.append_new_days(spark.sql("SELECT 1 AS v, '2026-07-12' AS load_date"), name)
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (load_date = '2026-07-13')")
    landed = tables.append_new_days(spark.sql("SELECT 2 AS v, explode(array('2026-07-12', '2026-07-13', '2026-07-14')) AS load_date"), name)
    assert (landed.appended_rows, landed.skipped_rows, landed.new_days) == (2, 1, ("2026-07-13", "2026-07-14"))


def test_decoding_settles_flat_lines_without_a_second_look(spark, tmp_path, weather):
    """Plain records and records with nested objects both come through the same way."""
    nested = RIGA[:-1] + ', "more": {"a": {"b": 1}}}'
    write_folder(tmp_path, "2026-07-12", [RIGA, nested, RIGA + "  ", " \t " + RIGA, " \t "])
    rows = accepted(classify(landing.parse_lines(landing.scan_lines(spark, str(tmp_path)), weather), weather), weather)
    assert rows.count() == 4
