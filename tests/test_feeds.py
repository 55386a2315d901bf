"""Feeds other than the weather one."""

import json

import pytest

from dayloom.operators import quality
from dayloom.plans import jobs
from dayloom.schemas import Feed, Field
from edge_lines import write_folder

SALES = Feed(
    (Field("sold_at", "timestamp", required=True, completed=True), Field("shop", required=True),
     Field("till", required=True), Field("cents", "long"), Field("weight", "double")),
    event_time="sold_at", keys=("shop", "till"), measures=("cents", "weight"), day="sold_on", day_type="date")


def sale(sold_at, shop, till, cents, **more):
    return json.dumps({"sold_at": sold_at, "shop": shop, "till": till, "cents": cents, **more})


def test_another_feed_runs_through_the_same_jobs(spark, database, tmp_path):
    write_folder(tmp_path, "2026-07-12", [
        sale("2026-07-12T07:30", "a", 1, 9_000_000_000), sale("2026-07-12T07:31", "a", 1, 9_000_000_002, weight=0.5),
        sale("2026-07-12T07:31", "a", 2, None), sale("2026-07-12T07:31", "b", 1, "12x"), sale("", "", None, 1)])
    lake = jobs.Lake(str(tmp_path), f"{database}.sales", f"{database}.by_day", f"{database}.bad", feed=SALES)
    jobs.create_tables(spark, lake)
    rows = jobs.run_daily(spark, lake, "2026-07-12", least_rows=3).collect()
    assert sorted((r.shop, r.till, r.record_count, r.avg_cents, r.avg_weight) for r in rows) == [
        ("a", "1", 2, 9_000_000_001.0, 0.5), ("a", "2", 1, None, None)]
    assert {r.reason for r in spark.table(lake.rejects).collect()} == {
        "invalid:cents", "missing:sold_at,missing:shop,missing:till"}
    checks = [quality.UniqueCheck("one_sale", ("sold_at", "shop", "till")), quality.not_null("cents", "cents")]
    assert [r.violations for r in jobs.quality_report(spark, lake, checks).collect()] == [1, 0]


@pytest.mark.parametrize("fields, options", [
    ((Field("at", "timestamp"), Field("line")), {}),
    ((Field("at", "timestamp"), Field("load_date")), {}),
    ((Field("at", "timestamp"), Field("at")), {}),
    ((Field("at", "instant"),), {}),
    ((Field("at", "timestamp"),), {"keys": ("shop",)}),
])
def test_feeds_are_checked(fields, options):
    with pytest.raises(ValueError):
        Feed(fields, "at", **{"keys": (), "measures": (), **options})
