"""Digests of long texts that come in fragments: equal for every cut of one text, without a row that holds it.

The digest is a polynomial of the text's bytes at three points, modulo primes. A fragment's own is computed where the
fragment lies; shifted by the bytes before it, the fragments of a text add up to the text's. What is shuffled is a row of
four numbers per fragment.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

# Three primes below 2**31, and the point that each polynomial is taken at.
MODULI = (2147483647, 2147483629, 2147483587)
POINTS = (1597334677, 1103515245, 1664525001)
STEP = 1 << 16


def polynomial(data: bytes, point: int, modulus: int) -> int:
    """Sum of byte[i] * point**i, block by block."""
    values = np.frombuffer(data, np.uint8).astype(np.int64) + 1  # a zero byte counts too
    total, scale = 0, 1
    powers = np.ones(min(STEP, max(1, len(values))), np.int64)
    filled = 1
    while filled < len(powers):
        more = min(filled, len(powers) - filled)
        powers[filled:filled + more] = powers[:more] * pow(point, filled, modulus) % modulus
        filled += more
    step = pow(point, STEP, modulus)
    for start in range(0, len(values), STEP):
        block = values[start:start + STEP]
        total = (total + int((block * powers[:len(block)] % modulus).sum()) % modulus * scale) % modulus
        scale = scale * step % modulus
    return total


def _own(fragments: pd.Series) -> pd.DataFrame:
    rows = []
    for text in fragments:
        data = b"" if text is None else text.encode("utf-8")
        rows.append((len(data), *(polynomial(data, p, m) for p, m in zip(POINTS, MODULI, strict=True))))
    return pd.DataFrame(rows, columns=["bytes", "d0", "d1", "d2"])


def _shifted(before: pd.Series, d0: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({
        f"d{k}": [int(d) * pow(p, int(b), m) % m for b, d in zip(before, own, strict=True)]
        for k, (own, p, m) in enumerate(zip((d0, d1, d2), POINTS, MODULI, strict=True))}, dtype="int64")


def text_digests(fragments: DataFrame, key: str, part: str, text: str) -> DataFrame:
    """``(key, parts, bytes, digest)`` of each text, from its fragments in the order of ``part``; NULL is an empty one.

    The running number of bytes is taken over rows of numbers: a text of any length has as many as it has fragments.
    """
    measure = F.pandas_udf(_own, "bytes long, d0 long, d1 long, d2 long")
    shift = F.pandas_udf(_shifted, "d0 long, d1 long, d2 long")
    own = fragments.select(key, F.col(part).alias("_part"), measure(F.col(text)).alias("own")).select(key, "_part", "own.*")
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = own.withColumn("before", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    moved = placed.select(key, "bytes", shift("before", "d0", "d1", "d2").alias("d")).select(key, "bytes", "d.*")
    summed = moved.groupBy(key).agg(F.count(F.lit(1)).alias("parts"), F.sum("bytes").alias("bytes"),
                                    *((F.sum(f"d{k}") % m).alias(f"d{k}") for k, m in enumerate(MODULI)))
    return summed.select(key, "parts", "bytes", F.concat_ws("-", *(F.lpad(F.hex(f"d{k}"), 8, "0") for k in range(3))).alias("digest"))
