"""Cutting groups of any size into ordered parts of bounded weight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dayloom.session import written

SALTS = 64


def heavy_keys(rows: DataFrame, key: str, weight: Column, limit: int) -> DataFrame | None:
    """``(key, total)`` of the keys whose weight exceeds ``limit``; None when there are none, the usual case.

    Totals are combined before the shuffle. The result is written, as it is used several times, but
    only if the weights say that there can be one.
    """
    totals = rows.groupBy(key).agg(F.sum(weight).alias("total")).where(F.col("total") > limit)
    return None if totals.isEmpty() else written(totals, "heavy-keys")


def split_by_keys(rows: DataFrame, keys: DataFrame, key: str, few: bool) -> tuple[DataFrame, DataFrame]:
    """``(rows of other keys, rows of these keys)``; a NULL key matches a NULL key.

    ``few`` says that ``keys`` was measured and is small: then it is broadcast. Otherwise the join
    shuffles, with each key spread over salts so that no task gets all rows of one key.
    """
    listed = keys.select(F.col(key).alias("_listed"))
    if few:
        listed = F.broadcast(listed)
        match = F.col(key).eqNullSafe(F.col("_listed"))
        return rows.join(listed, match, "left_anti"), rows.join(listed, match, "left_semi")
    listed = listed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # copies of a row are dealt out too, or a row with very many of them would be one task's
    salted = rows.withColumn("_row_salt", F.floor(F.rand(7) * SALTS).cast("int"))
    match = F.col(key).eqNullSafe(F.col("_listed")) & (F.col("_row_salt") == F.col("_salt"))
    return (salted.join(listed, match, "left_anti").drop("_row_salt"),
            salted.join(listed, match, "left_semi").drop("_row_salt"))


def weight_before(rows: DataFrame, key: str, order: list[str], weight: Column, few: bool) -> DataFrame:
    """Adds ``weight`` and ``before``, the weight of all earlier rows of the same key in ``order``.

    A window over the key would sort one hot key in one task. Instead the rows are range
    partitioned by (key, order), so a hot key spans many slices; each slice is summed, the slice
    totals are run up per key (at most one row per slice), and only the rest is computed inside a
    slice. ``order`` should tell the rows of a key apart; its columns must be short, because Spark
    samples them to the driver to place the borders. Other columns only break ties. The slices
    are written once: their borders must not change between the two uses. There are at most as
    many (key, slice) pairs as keys and slices, so with ``few`` keys their offsets are broadcast.
    """
    others = [c for c in rows.columns if c not in (key, *order)]
    sliced = written(
        rows.withColumn("weight", weight).repartitionByRange(key, *order)
        .withColumn("slice", F.spark_partition_id()),
        "slices",
    )
    earlier_slices = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(key, "slice").agg(F.sum("weight").alias("in_slice"))
        .select(F.col(key).alias("_key"), F.col("slice").alias("_slice"),
                F.coalesce(F.sum("in_slice").over(earlier_slices), F.lit(0)).alias("offset"))
    )
    if few:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(key, "slice").orderBy(*order, *others).rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.withColumn("inside", F.coalesce(F.sum("weight").over(inside), F.lit(0)))
    return (
        placed.join(offsets, (F.col("slice") == F.col("_slice")) & F.col(key).eqNullSafe(F.col("_key")))
        .select(*rows.columns, "weight", (F.col("offset") + F.col("inside")).alias("before"))
    )


def ordered_parts(rows: DataFrame, key: str, order: list[str], weight: Column, limit: int,
                  few: bool = False) -> DataFrame:
    """Adds ``part``, the weight before a row divided by ``limit``, and ``copies``.

    Equal rows are counted first, so that any number of copies travels as one row; copies that
    reach over a border are shared out by arithmetic. A part weighs at most ``limit`` plus one row.
    """
    distinct = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    placed = weight_before(distinct, key, order, weight * F.col("copies"), few).withColumn(
        "each", F.expr("weight div copies"))
    spread = placed.withColumn("part", F.explode(F.sequence(
        F.expr(f"before div {limit}"), F.expr(f"(before + (copies - 1) * each) div {limit}"))))

    def starting_before(border: str) -> Column:
        return F.expr(f"least(copies, greatest(0L, ({border} - before + each - 1) div each))")

    here = starting_before(f"(part + 1) * {limit}") - starting_before(f"part * {limit}")
    return spread.withColumn("copies", here).where(F.col("copies") > 0).select(*rows.columns, "part", "copies")
