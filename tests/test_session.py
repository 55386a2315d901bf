import os

import pytest

from dayloom.session import fresh_folder, shared_folder, staged, use_utc, written
from plan_text import setting


def test_the_named_shared_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
    assert fresh_folder(spark, "x").startswith(shared_folder(spark))


class Context:
    """As much of a session as naming the shared folder needs."""

    def __init__(self, master, named=None, current=None):
        self.master, self.named, self.current, self.sparkContext, self.conf = master, named, current, self, self

    def get(self, key, default):
        return self.named or default

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


def test_only_a_local_session_gets_a_folder_of_its_own():
    assert shared_folder(Context("yarn", "hdfs://shared/checkpoints/")) == "hdfs://shared/checkpoints"
    assert shared_folder(Context("yarn", None, "hdfs://set/before")) == "hdfs://set/before"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Context("yarn"))
    local = Context("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.current


def test_written_and_staged(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    assert written(df, "test").where("twice = 2 * id").count() == 10
    with staged(df, "test") as once:
        path = once.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
        assert once.count() == 10 and os.path.isdir(path)
    assert not os.path.exists(path)
    with pytest.raises(RuntimeError):
        with staged(df, "test") as once:
            path = once.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
            raise RuntimeError
    assert not os.path.exists(path)


def test_setting_is_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with setting(spark, "spark.sql.shuffle.partitions", "3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with setting(spark, "spark.sql.session.timeZone", "Asia/Tokyo"):
        use_utc(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
