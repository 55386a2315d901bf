from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from dayloom.functions.casts import to_type
from dayloom.operators.validate import accepted, classify, rejected, require
from dayloom.sources import landing
from dayloom.operators.sizes import is_small
from dayloom.sources.payloads import city_dimension, flatten_payload, lookup
from edge_lines import LINES, NOT_ONE_OBJECT, RIGA, write_folder
from plan_text import executed_plan
from plan_text import setting

DAY = "2026-07-12"


@pytest.fixture
def edge_root(tmp_path):
    write_folder(tmp_path, DAY, [line for line, _ in LINES])
    return str(tmp_path)


def classified(spark, root, weather, **options):
    return classify(landing.parse_lines(landing.scan_lines(spark, root), weather), weather, **options)


def test_every_edge_line_has_its_outcome(spark, edge_root, weather):
    got = classified(spark, edge_root, weather)
    reasons = {row.raw_line: row.reason for row in rejected(got).collect()}
    assert reasons == {line: reason for line, reason in LINES if reason not in (None, "blank")}
    assert accepted(got, weather).count() == 9 and rejected(got).count() == 12


def test_values_of_accepted_lines(spark, edge_root, weather):
    rows = accepted(classified(spark, edge_root, weather), weather)
    assert rows.columns[-2:] == ["source_file", "load_date"]
    by_city = {(r.city, r.ingested_at): r for r in rows.collect()}
    riga = by_city["Riga", datetime(2026, 7, 12, 7, 44, 7, 123456)]
    assert riga.observed_at == datetime(2026, 7, 12, 7, 30)
    assert (riga.temperature_c, riga.humidity_pct, riga.wind_speed_kmh) == (23.3, 71, 5.0)
    assert riga.source_file.endswith("load_date=2026-07-12/part.json")
    days = {r.city: r.load_date for r in rows.collect()}
    assert days["Warsaw"] in ("2026-07-11", "2026-07-12")
    assert rows.where("load_date = '2026-07-11'").count() == 1
    assert {"0", " "} <= set(days)
    assert rows.where("temperature_c IS NULL").count() == 2


def test_milliseconds_and_pattern_lineage(spark, edge_root, weather):
    lines = landing.scan_run_date(spark, edge_root, DAY, lineage="pattern")
    rows = accepted(classify(landing.parse_lines(lines, weather), weather, milliseconds=True), weather)
    stamps = {r.ingested_at.microsecond for r in rows.collect()}
    assert stamps == {0, 123000}
    assert {r.source_file for r in rows.collect()} == {f"{edge_root}/load_date={DAY}/*"}


def test_always_rule_makes_marked_text_unreadable(spark, edge_root, weather):
    reasons = rejected(classified(spark, edge_root, weather, timestamp_rule="always"))
    assert reasons.where("reason = 'invalid:observed_at'").count() == 4


def test_strict_mode_fails_on_the_first_bad_value(spark, tmp_path, weather):
    write_folder(tmp_path, DAY, [LINES[0][0], LINES[3][0], "not json"])
    assert accepted(classified(spark, str(tmp_path), weather, mode="strict"), weather).count() == 1
    write_folder(tmp_path, DAY, [LINES[11][0]], "bad.json")
    with pytest.raises(Exception, match="invalid:humidity_pct"):
        accepted(classified(spark, str(tmp_path), weather, mode="strict"), weather).collect()


def test_a_line_is_one_object_and_nothing_else(spark, tmp_path, weather):
    nested = RIGA[:-1] + ', "extra": {"a": [1, {"b": "}"}]}}'
    write_folder(tmp_path, DAY, [*NOT_ONE_OBJECT, nested, "  " + RIGA + " \t"])
    got = classified(spark, str(tmp_path), weather)
    assert accepted(got, weather).count() == 2
    assert sorted(r.raw_line for r in rejected(got).collect()) == sorted(NOT_ONE_OBJECT)


def test_text_table_keeps_number_text(spark, edge_root, weather):
    table = landing.scan_ndjson(spark, edge_root, weather)
    assert dict(table.dtypes)["load_date"] == "string"
    riga = table.where("ingested_at LIKE '%123456%'").first()
    assert (riga.temperature_c, riga.humidity_pct, riga.wind_speed_kmh) == ("23.3", "71", "5.0")
    corrupt = table.select("city", "_corrupt").where("_corrupt IS NOT NULL").collect()
    assert len(corrupt) == 3 and all(r.city is None for r in corrupt)
    assert len(table.collect()) == 21


@pytest.mark.parametrize("kind, good, bad", [
    ("timestamp", ["2026-07-12T07:44:07+00:00", "2026-07-12 07:44:07.123", "2026-07-12", "2026-7-2T7:4:7Z"],
     ["12:30", "T12:30:00", "2026", "2026-07", "12345", "yesterday", "+12026-01-01T00:00:00Z", "20260712T074407Z",
      "12:3-02:00", "2026-07-"]),
    ("double", ["23.3", "-1e3", "5", ".5", " 7 ", "NaN", "-Infinity", "inf"],
     ["23.3f", "1.5d ", "0x1p3", "1_0", "", "n/a", "true"]),
    ("int", ["71", "-3", "+5"], ["71.5", "71.0", "7e1", "2147483648", "", "0x10"]),
    ("string", ["", "x"], []),
])
def test_text_to_types(spark, kind, good, bad):
    df = spark.createDataFrame([(text,) for text in good + bad], "text string")
    read = {r.text for r in df.where(to_type(F.col("text"), kind).isNotNull()).collect()}
    assert read == set(good)


def test_require_treats_blank_and_zero_as_present(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), (" ",), ("0",)], "x string")
    assert sorted(r.x for r in require(df, ["x"]).collect()) == [" ", "0", "a"]


def test_day_folders_are_projected(spark, tmp_path, weather):
    for day in ("2025-12-31", "2026-01-01", "2026-01-03", "2026-02-01"):
        write_folder(tmp_path, day, [RIGA])
    root = str(tmp_path)

    def days(**scope):
        return sorted(r.load_date for r in landing.scan_ndjson(spark, root, weather, **scope).collect())

    assert days(start="2026-01-01", end="2026-01-31") == ["2026-01-01", "2026-01-03"]
    assert days(start="2026-01-01") == ["2026-01-01", "2026-01-03", "2026-02-01"]
    assert days(start="2020-01-01", end="2026-01-01") == ["2025-12-31", "2026-01-01"]
    assert days(start="2026-03-01", end="2026-03-02") == []
    assert days(start="2026-03-02", end="2026-03-01") == []
    assert landing.scan_run_date(spark, root, "2026-01-03").count() == 1
    for first, last in (("2026-03-01", "2026-03-01"), ("2026-03-01", None), ("2030-01-01", "2035-01-01"), (None, "2020-01-01")):
        with pytest.raises(FileNotFoundError, match="PATH_NOT_FOUND"):
            landing.scan_lines(spark, root, first, last, on_missing="fail")
        assert landing.scan_lines(spark, root, first, last).count() == 0
    assert landing.scan_run_date(spark, root, "2026-03-01", on_missing="empty").count() == 0
    filtered = landing.scan_ndjson(spark, root, weather, start="2026-01-01")
    assert all("load_date=2026-" in name for name in filtered.inputFiles())


def test_landing_writes_null_and_counts(spark, tmp_path, weather):
    root = str(tmp_path / "raw")
    df = spark.range(5).select(F.col("id").cast("string").alias("city"), F.lit(None).cast("double").alias("temperature_c"))
    told = landing.land_ndjson(df, root, datetime(2026, 7, 12, 23, 30, tzinfo=timezone.utc))
    assert told == {"root": root, "folder": "load_date=2026-07-12", "records": 5}
    assert landing.land_ndjson(df, root, datetime(2026, 7, 12, 23, 40))["records"] == 5
    lines = landing.scan_run_date(spark, root, DAY)
    assert lines.count() == 10
    assert all('"temperature_c":null' in r.line for r in lines.collect())
    for nothing in (df.where("false"), df.limit(0), spark.createDataFrame([], df.schema)):
        assert landing.land_ndjson(nothing, root, datetime(2026, 7, 12, 23, 50))["records"] == 0
    assert landing.scan_run_date(spark, root, datetime(2026, 7, 12, 5)).count() == 10


def test_landing_retention(spark, tmp_path):
    for n in range(1, 11):
        write_folder(tmp_path, f"2026-07-{n:02d}", [RIGA])
    gone = landing.expire_landing(spark, str(tmp_path), "2026-07-10", 7)
    assert gone == ["2026-07-01", "2026-07-02", "2026-07-03"]
    assert len(list(tmp_path.iterdir())) == 7


PAYLOADS = [
    ("Riga", '{"latitude": 1, "current": {"time": "2026-07-12T07:30", "temperature_2m": 23.3, '
             '"relative_humidity_2m": 71, "wind_speed_10m": 5.0}}'),
    ("Warsaw", '{"current": {"time": "2026-07-12T07:30"}}'),
]


def test_payload_is_flattened_with_dimension_attributes(spark):
    payloads = spark.createDataFrame(PAYLOADS, "city string, payload string")
    rows = {r.city: r for r in flatten_payload(
        payloads, city_dimension(spark), as_of="2026-07-12 07:44:07").collect()}
    riga = rows["Riga"]
    assert (riga.latitude, riga.longitude, riga.country) == (56.9496, 24.1052, "Latvia")
    assert (riga.temperature_c, riga.humidity_pct, riga.wind_speed_kmh) == (23.3, 71, 5.0)
    assert riga.ingested_at == "2026-07-12T07:44:07.000000+00:00"
    assert rows["Warsaw"].temperature_c is None


def test_payload_without_time(spark):
    bad = [("Riga", '{"current": {"temperature_2m": 1.0}}'), ("Riga", "{}"), ("Riga", "no json"),
           ("Riga", '{"current": {"time": "t", "relative_humidity_2m": 71.5}}'),
           ("Oslo", PAYLOADS[0][1])]
    payloads = spark.createDataFrame(PAYLOADS + bad, "city string, payload string")
    reasons = sorted(str(r.reason) for r in flatten_payload(
        payloads, city_dimension(spark), mode="reject").collect())
    assert reasons == ["None", "None", "invalid:humidity_pct", "missing:time", "missing:time", "missing:time",
                       "unknown:city"]
    for faulty in bad:
        one = spark.createDataFrame([faulty], "city string, payload string")
        with pytest.raises(Exception, match=f"payload of {faulty[0]}"):
            flatten_payload(one, city_dimension(spark)).count()


def test_dimension_is_broadcast_only_when_small(spark):
    """The dimension is the broadcast side although the facts are smaller still."""
    facts = spark.createDataFrame([("Riga", 1), ("Warsaw", 2), ("Oslo", 3)], "city string, n int")
    cities = city_dimension(spark)
    assert is_small(cities) and not is_small(cities, most_rows=3) and not is_small(cities, most_bytes=10)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):  # leave the choice to lookup
        small, large = lookup(facts, cities, "city"), lookup(facts, cities, "city", most_rows=3)
        assert "BuildRight" in executed_plan(small) and "SortMergeJoin" not in executed_plan(small)
        assert "SortMergeJoin" in executed_plan(large)
    assert sorted(small.collect()) == sorted(large.collect()) and small.count() == 2
