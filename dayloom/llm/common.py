"""Helpers of the operators: whole-text word arrays, slices of bounded size, reading the tables."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step works on; a longer document is a step of its own.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text, and what else is named; any other column stays behind. A null text is empty."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def held_out(key: str, modulus: int, remainder: int):
    """Whether crc32 of the key as text leaves this remainder; a null key counts as empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(modulus)) == F.lit(remainder)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose text is some ``limit`` bytes; a row is never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def per_slice(function: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str = "text",
              limit: int = SLICE_BYTES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that applies ``function`` to runs of rows of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, limit):
                made = function(part)
                if made is not None and made.num_rows:
                    yield made
            del batch
            pa.default_memory_pool().release_unused()  # a worker lives on through other stages

    return run


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python gets at most so many rows at a time from what is run inside: rows that hold texts or arrays are large, and
    both sides keep a batch whole. No result depends on it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release_memory() -> None:
    """Give back to the system what this worker holds and does not use; it lives on through other stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
         ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that leaves no memory behind, neither of its own nor of the stage before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        yield from function(batches)
        release_memory()

    return run


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts in a row, and where each text's begin (one entry more than texts)."""
    lists = pc.ascii_split_whitespace(texts)
    flat, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    real = pc.not_equal(pc.binary_length(flat), 0)
    mask = np.asarray(real.to_numpy(zero_copy_only=False), dtype=bool)
    if not mask.all():
        offsets = np.concatenate([[0], np.cumsum(mask)])[offsets]
        flat = flat.filter(real)
    return flat, offsets


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words as numbers into a vocabulary of the distinct ones, and where each text's words begin."""
    flat, offsets = words(texts)
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets, coded.dictionary


def translated(texts: pa.Array, mapping: bytes) -> pa.Array:
    """Each byte of the texts by a table of 256; the table must leave UTF-8 valid (change ASCII to ASCII only)."""
    texts = pa.concat_arrays([texts])  # offsets from the buffer's start
    valid, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return texts
    moved = np.frombuffer(mapping, np.uint8)[np.frombuffer(data, np.uint8)]
    return pa.Array.from_buffers(texts.type, len(texts), [valid, offsets, pa.py_buffer(moved)], offset=texts.offset)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashes(values: pa.Array) -> np.ndarray:
    """64-bit hash of each string, the same in every task."""
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, values.cast(pa.binary()).to_pylist()), np.uint64, len(values))


def window_hashes(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, for each start that has so many words after it."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += word_hash[i:i + n]
    return mixed(total)


def counts_per(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights=weights, minlength=n).astype(np.int64)


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each item the number of the list that it is in."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
