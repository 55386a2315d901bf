import pytest

from dayloom.__main__ import main
from edge_lines import LINES, RIGA, write_folder

DAY = "2026-07-12"


@pytest.fixture
def call(spark, database, tmp_path, capsys):
    names = ["--root", str(tmp_path / "raw"), "--facts", f"{database}.facts", "--summary", f"{database}.daily",
             "--rejects", f"{database}.rejects", "--cluster-by", "city"]

    def run(command, *more):
        code = main([command, *names, *more])
        return code, capsys.readouterr().out

    run.database = database
    return run


def test_daily_commands(spark, call, tmp_path):
    write_folder(tmp_path / "raw", DAY, [line for line, _ in LINES])
    assert call("create-tables")[0] == 0
    assert call("run-daily", "--date", DAY)[0] == 0
    assert spark.table(f"{call.database}.facts").count() == 9
    assert spark.table(f"{call.database}.rejects").count() == 12
    assert call("run-daily", "--date", DAY, "--least-rows", "99")[0] == 1
    assert call("load", "--date", DAY)[0] == 0
    assert call("refresh-summary", "--round-digits", "2")[0] == 0
    assert call("report")[0] == 1  # the folder was loaded more than once
    assert call("expire", "--date", "2026-07-19")[1] == "removed 1 folders and 2 partitions\n"


def test_build_report_and_ingest(spark, call, tmp_path):
    write_folder(tmp_path / "raw", DAY, [RIGA])
    assert call("build-all") == (0, "appended 1 rows, skipped 0; 8 checks passed\n")
    assert call("build-all", "--only-new-days", "--start", DAY) == (0, "appended 0 rows, skipped 1; 8 checks passed\n")
    code, out = call("report")
    assert code == 0 and out.count("PASS") == 6
    target = str(tmp_path / "ingested")
    for _ in range(2):
        assert call("ingest", "--target", target, "--checkpoint", f"{target}-log")[0] == 0
    assert spark.read.parquet(target).count() == 1


def test_a_date_must_be_a_date(call):
    with pytest.raises(SystemExit):
        call("load", "--date", "yesterday")
