"""Helpers of tests about plans."""

from contextlib import contextmanager


@contextmanager
def setting(spark, key, value):
    """A session setting for the statements inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def executed_plan(df) -> str:
    """The physical plan as text, without running it."""
    return df._jdf.queryExecution().executedPlan().toString()
