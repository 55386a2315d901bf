import pytest

from dayloom.operators import quality
from dayloom.operators.rollup import daily_rollup
from plan_text import executed_plan

SCHEMA = ("observed_at timestamp, ingested_at timestamp, city string, temperature_c double, "
          "humidity_pct int, wind_speed_kmh double, load_date string")
CLEAN = [(f"2026-07-12 07:{m:02d}:00", "Riga", 20.0, 50, 3.0) for m in range(4)]
DIRTY = CLEAN + [
    (None, "Riga", 20.0, 50, 3.0),
    ("2026-07-12 07:00:00", "Riga", 75.0, 101, -1.0),
    ("2026-07-12 07:00:00", "Riga", -60.5, -1, 0.0),
    ("2026-07-12 07:01:00", "Riga", None, None, None),
    ("2026-07-12 08:00:00", None, float("nan"), 0, 100.0),
]


def facts(spark, rows):
    from datetime import datetime

    def instant(text):
        return None if text is None else datetime.fromisoformat(text)

    data = [(instant(t), datetime(2026, 7, 12, 9), c, *m, "2026-07-12") for t, c, *m in rows]
    return spark.createDataFrame(data, SCHEMA)


def summary(df):
    return daily_rollup(df, "load_date", ["city"], ["temperature_c"])


def result(df):
    return {r.check_name: (r.violations, r.status) for r in df.collect()}


def test_clean_facts_pass(spark):
    df = facts(spark, CLEAN)
    rows = quality.gate(quality.report(df, quality.warehouse_checks(summary(df))))
    assert [r.check_name for r in rows] == sorted(r.check_name for r in rows) and len(rows) == 6
    assert all(r.violations == 0 and r.status == "PASS" for r in rows)
    assert len(quality.gate(quality.report(df, quality.model_checks()))) == 7


def test_dirty_facts_count_violations(spark):
    df = facts(spark, DIRTY)
    got = result(quality.report(df, quality.warehouse_checks(summary(facts(spark, CLEAN)))))
    assert got == {
        "humidity_in_range": (2, "FAIL"),
        "no_duplicate_observation": (2, "FAIL"),  # groups: 07:00 (three rows) and 07:01 (two)
        "no_null_required": (2, "FAIL"),
        "summary_reconciles_source": (5, "FAIL"),
        "temperature_in_range": (2, "FAIL"),
        "wind_speed_non_negative": (1, "FAIL"),
    }
    models = result(quality.report(df, quality.model_checks()))
    assert models["not_null_temperature_c"] == (1, "FAIL")
    assert models["accepted_range_temperature_c"] == (3, "FAIL")  # a negated range test flags NaN
    with pytest.raises(quality.DataQualityError, match="unique_city_observed_at=2"):
        quality.gate(quality.report(df, quality.model_checks()))


def test_empty_facts(spark):
    df = facts(spark, [])
    got = result(quality.report(df, [*quality.warehouse_checks(summary(df)), quality.MinRowsCheck("rows", 1)]))
    assert got.pop("rows") == (1, "FAIL")
    assert set(got.values()) == {(0, "PASS")}


def test_reconcile_limited_to_days(spark):
    df = facts(spark, CLEAN)
    expired = summary(df).unionAll(spark.sql("SELECT 'Riga', 9L, 1.0D, '2026-07-01'"))
    whole = quality.ReconcileCheck("r", expired)
    scoped = quality.ReconcileCheck("r", expired, day="load_date", days=("2026-07-12",))
    assert result(quality.report(df, [whole])) == {"r": (9, "FAIL")}
    assert result(quality.report(df, [scoped])) == {"r": (0, "PASS")}
    assert [tuple(r) for r in quality.reconcile(df, expired).collect()] == [(4, 13)]
    assert quality.reconcile(df, summary(df)).collect() == []
    gaps = quality.reconcile_landing(facts(spark, DIRTY), df, ["load_date"])
    assert sum(r.lost_rows - r.surplus_rows for r in gaps.collect()) == 5
    assert quality.reconcile_landing(df, df, ["load_date"]).collect() == []


def test_a_doubled_day_does_not_hide_a_lost_one(spark):
    landed = spark.sql("SELECT explode(array('a', 'a', 'b', 'b', 'c')) AS d")
    held = spark.sql("SELECT explode(array('a', 'a', 'a', 'a', 'c')) AS d")
    rows = quality.reconcile_landing(landed, held, ["d"]).orderBy("d").collect()
    assert [tuple(r) for r in rows] == [("a", 2, 4, 0, 2), ("b", 2, 0, 2, 0)]


def test_min_rows(spark):
    df = facts(spark, CLEAN)
    assert result(quality.report(df, [quality.MinRowsCheck("n", 4)])) == {"n": (0, "PASS")}
    assert result(quality.report(df, [quality.MinRowsCheck("n", 5)])) == {"n": (1, "FAIL")}
    other_day = quality.MinRowsCheck("n", 1, "load_date", ("2026-07-13",))
    assert result(quality.report(df, [other_day])) == {"n": (1, "FAIL")}


def test_bounds_and_names_are_checked(spark):
    with pytest.raises(ValueError):
        quality.in_range("r", "x")
    with pytest.raises(ValueError):
        quality.report(facts(spark, CLEAN), [quality.not_null("a", "city"), quality.not_null("a", "city")])


def test_row_checks_share_one_scan(spark, tmp_path):
    facts(spark, CLEAN).write.parquet(str(tmp_path / "f"))
    df = spark.read.parquet(str(tmp_path / "f"))
    assert executed_plan(quality.report(df, quality.model_checks())).count("FileScan parquet") == 2
    only_rows = [c for c in quality.model_checks() if isinstance(c, quality.RowCheck)]
    assert executed_plan(quality.report(df, only_rows)).count("FileScan parquet") == 1
