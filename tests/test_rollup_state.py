"""Mergeable sums of the daily rollup, and compaction of day and batch partitions."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from dayloom.operators import compaction, rollup_state, tables
from dayloom.operators.rollup import daily_rollup
from dayloom.schemas import WEATHER
from dayloom.session import fresh_database
from dayloom.streaming.ingest import create_ingest_tables, ingest_into_tables
from edge_lines import LINES, RIGA, write_folder

MEASURES = ["temperature_c", "humidity_pct", "wind_speed_kmh"]
SCHEMA = "city string, temperature_c double, humidity_pct int, wind_speed_kmh double, load_date string, batch int"


def readings(seed, n=400):
    """Quarter degrees, so that sums do not depend on their order."""
    rng = random.Random(seed)
    return [(rng.choice(["Riga", "Vilnius", None]), rng.choice([None, rng.randint(-80, 160) / 4]), rng.choice([None, rng.randint(0, 100)]),
             None, f"2026-07-{rng.randint(1, 6):02d}", rng.randint(0, 4)) for _ in range(n)]


def made(frame):
    return sorted(map(tuple, frame.select("city", "record_count", *(f"avg_{m}" for m in MEASURES), "load_date").collect()), key=repr)


@pytest.fixture
def state(spark, database):
    name = f"{database}.state"
    rollup_state.create_state(spark, name, WEATHER)
    return name


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_and_again_make_the_fresh_rollup(spark, state, seed):
    rows = spark.createDataFrame(readings(seed), SCHEMA)
    order = [0, 1, 2, 3, 4, 2, 0]
    random.Random(seed).shuffle(order)
    for n, batch in enumerate(order):
        days = rollup_state.merge(spark, state, rows.where(F.col("batch") == batch).drop("batch"), f"b{batch}", WEATHER)
        assert bool(days) == (batch not in order[:n])
        fresh = daily_rollup(rows.where(F.col("batch").isin(order[:n + 1])), "load_date", ["city"], MEASURES)
        assert made(rollup_state.rollup_of(spark.table(state), WEATHER)) == made(fresh)
    tables.expire(spark, state, "load_date", "2026-07-08", 5)
    kept = daily_rollup(rows.where("load_date > '2026-07-03'"), "load_date", ["city"], MEASURES, 2)
    assert made(rollup_state.rollup_of(spark.table(state), WEATHER, 2)) == made(kept)


def test_a_merge_that_died_half_way_is_completed(spark, state):
    """One day has the batch, the other does not: the batch that comes again goes to that one only."""
    rows = spark.createDataFrame(readings(3), SCHEMA).drop("batch")
    assert rollup_state.merge(spark, state, rows.where("load_date = '2026-07-02'"), "b", WEATHER) == ["2026-07-02"]
    assert "2026-07-02" not in rollup_state.merge(spark, state, rows, "b", WEATHER)
    assert made(rollup_state.rollup_of(spark.table(state), WEATHER)) == made(daily_rollup(rows, "load_date", ["city"], MEASURES))


def test_a_merge_reads_no_other_days(spark, state):
    rows = spark.createDataFrame(readings(4), SCHEMA).drop("batch")
    rollup_state.merge(spark, state, rows, "b", WEATHER)
    files = {r[0]: r[1] for r in spark.table(state).select("load_date", F.input_file_name()).distinct().collect()}
    rollup_state.merge(spark, state, rows.where("load_date = '2026-07-01'"), "late", WEATHER)
    after = {r[0]: r[1] for r in spark.table(state).select("load_date", F.input_file_name()).distinct().collect()}
    assert {d for d in files if files[d] != after[d]} == {"2026-07-01"}
    assert rollup_state.merge(spark, state, rows.limit(0), "none", WEATHER) == []
    assert rollup_state.merge(spark, state, rows.withColumn("load_date", F.lit(None).cast("string")), "dayless", WEATHER) == []


def test_sums_that_are_not_exact_agree_closely(spark, state):
    rows = spark.range(300).selectExpr("'Riga' AS city", "id / 7D AS temperature_c", "cast(id % 9 AS int) AS humidity_pct",
                                       "1e300 * (id % 2) AS wind_speed_kmh", "'2026-07-01' AS load_date", "id % 3 AS batch")
    for b in range(3):
        rollup_state.merge(spark, state, rows.where(f"batch = {b}"), str(b), WEATHER)
    got = rollup_state.rollup_of(spark.table(state), WEATHER).first()
    want = daily_rollup(rows, "load_date", ["city"], MEASURES).first()
    assert got.avg_temperature_c == pytest.approx(want.avg_temperature_c, rel=1e-13)
    assert got.avg_wind_speed_kmh == pytest.approx(want.avg_wind_speed_kmh, rel=1e-13)


# ---- the ingest: state and compaction

@pytest.fixture
def filled(spark, database, tmp_path):
    """Tables that five batches have filled, two days each, with the state beside them."""
    names = [f"{database}.{n}" for n in ("facts", "rejects", "state")]
    create_ingest_tables(spark, *names[:2], WEATHER)
    rollup_state.create_state(spark, names[2], WEATHER)
    root, log = tmp_path / "raw", str(tmp_path / "log")

    def run(**options):
        ingest_into_tables(spark, str(root), *names[:2], log, WEATHER, state=names[2], **options)

    for n in range(5):
        later = RIGA.replace("2026-07-12T07:30", f"2026-07-13T0{n}:30")
        write_folder(root, "2026-07-12", [later, RIGA.replace("07:30", f"0{n}:15"), "broken"], f"{n}.json")
    run(files_per_batch=1)
    return names, run, root, log


def partitions(spark, table, day="2026-07-12"):
    return sorted(r[0] for r in spark.table(table).where(F.col("load_date") == day).select("batch_id").distinct().collect())


def content(spark, table):
    frame = spark.table(table).drop("batch_id")
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_the_ingest_keeps_the_state(spark, filled):
    (facts, _, state), run, root, _ = filled
    write_folder(root, "2026-07-12", [line for line, _ in LINES], "late.json")
    run()
    fresh = daily_rollup(spark.table(facts), "load_date", ["city"], MEASURES, 6)
    assert made(rollup_state.rollup_of(spark.table(state), WEATHER, 6)) == made(fresh)


def test_small_batches_are_laid_together(spark, filled):
    (facts, rejects, _), run, root, log = filled
    before, faulty = content(spark, facts), content(spark, rejects)
    assert partitions(spark, facts) == list(range(5))
    assert compaction.compact(spark, facts) == 6 and compaction.compact(spark, rejects) == 3
    assert partitions(spark, facts) == [3, 4] == partitions(spark, rejects)
    assert (content(spark, facts), content(spark, rejects)) == (before, faulty)
    assert spark.table(facts).where("load_date = '2026-07-12'").select(F.input_file_name()).distinct().count() == 2
    assert compaction.compact(spark, facts) == 0
    shutil.rmtree(f"{log}/commits")  # the newest batch runs again: its partition was left alone
    run()
    assert content(spark, facts) == before
    write_folder(root, "2026-07-12", [RIGA], "more.json")
    run()
    assert len(content(spark, facts)) == len(before) + 1 and compaction.compact(spark, facts) >= 1
    assert partitions(spark, facts) == [4, 5] and len(content(spark, facts)) == len(before) + 1


def test_runs_fill_the_target_and_days_are_chosen(spark, filled):
    (facts, _, _), *_ = filled
    size = compaction.partition_sizes(spark.table(facts), "load_date", "batch_id").agg(F.max("bytes")).first()[0]
    before = content(spark, facts)
    compaction.compact(spark, facts, days=["2026-07-13"], target=2 * size)
    assert partitions(spark, facts) == list(range(5))
    assert 2 <= len(partitions(spark, facts, "2026-07-13")) <= 3
    assert content(spark, facts) == before


def test_a_compaction_that_died_is_finished(spark, filled, monkeypatch):
    (facts, _, _), run, root, _ = filled
    before = content(spark, facts)
    drop = compaction._drop

    def die(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(compaction, "_drop", die)
    with pytest.raises(KeyboardInterrupt):
        compaction.compact(spark, facts)
    monkeypatch.setattr(compaction, "_drop", drop)
    assert len(content(spark, facts)) > len(before)  # written and not yet dropped: what finish_compaction is for
    write_folder(root, "2026-07-13", ["broken"], "next.json")
    run()
    assert content(spark, facts) == before and partitions(spark, facts)[0] == 3


def test_other_tables_are_refused(spark, database):
    name = f"{fresh_database(spark, 'plain')}.t"
    tables.rebuild(spark.sql("SELECT 1 AS v, '2026-07-12' AS load_date"), name, "load_date")
    assert compaction.finish_compaction(spark, name) == 0
    with pytest.raises(ValueError, match="not partitioned by day and batch"):
        compaction.compact(spark, name)
