"""Fingerprints of groups of rows: do two tables hold the same rows, whatever their order, without joining them.

A fingerprint is a number of rows and two sums of row hashes. Equal multisets of rows have equal ones; others differ
but for chance (some 2**-100 for a pair of groups). Sums combine before the shuffle, so what moves is one row per task
and group. Groups whose fingerprints agree need no second look; only the others are compared row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

SECOND_SEED = 0x5EED
SUMS = ("row_count", "hash_a", "hash_b")
WIDE = "decimal(38,0)"


def row_hashes(schema: T.StructType, columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. NULL counts as a value of its own, which Spark's hash would pass over."""
    parts: list[Column] = []
    for name in columns:
        nested = isinstance(schema[name].dataType, T.ArrayType | T.MapType | T.StructType)
        parts += [F.col(name).isNull(), F.to_json(F.struct(name)) if nested else F.col(name)]
    return F.xxhash64(*parts), F.xxhash64(F.lit(SECOND_SEED), *parts)


def fingerprints(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """Per group of ``by`` the number of rows and the sums of their hashes, over ``columns`` or all of them."""
    columns = sorted(df.columns if columns is None else columns)
    first, second = row_hashes(df.schema, columns)
    hashed = df.select(*by, first.cast(WIDE).alias("a"), second.cast(WIDE).alias("b"))
    return hashed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("a").alias("hash_a"), F.sum("b").alias("hash_b"))


def difference(left: DataFrame, right: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """The groups of ``by`` in which the two do not hold the same rows: ``(*by, left_rows, right_rows)``.

    Fingerprints are subtracted, which is one more sum: there is no join, and NULL is a group like any other.
    """
    columns = [c for c in left.columns if c in right.columns] if columns is None else columns
    zero = F.lit(0).cast("bigint")
    ours = fingerprints(left, by, columns).select(
        *by, F.col("row_count").alias("left_rows"), zero.alias("right_rows"), "hash_a", "hash_b")
    theirs = fingerprints(right, by, columns).select(
        *by, zero.alias("left_rows"), F.col("row_count").alias("right_rows"),
        *((-F.col(h)).cast(WIDE).alias(h) for h in ("hash_a", "hash_b")))
    summed = ours.unionByName(theirs).groupBy(*by).agg(
        *(F.sum(c).alias(c) for c in ("left_rows", "right_rows", "hash_a", "hash_b")))
    return summed.where("left_rows != right_rows OR hash_a != 0 OR hash_b != 0").select(*by, "left_rows", "right_rows")
