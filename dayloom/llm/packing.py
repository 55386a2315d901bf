"""Best-fit packing of tokenised documents by a plan over the histogram of lengths.

The plan is made from counts alone: longest pieces first, each length goes into the open sequences with the least room
that holds it, as many at once as their number allows. It is a list of runs "ranks a.. of length l take sequences s..
at offset o", some thousands of them whatever the corpus. Pieces then find their slot by their rank among those of
their length; ranks are given in salted parts, so that a very common length is no single task.

Defined cases: a null or empty text is one piece, the end token alone; a null doc_id is packed like any other;
repeated rows are packed each; an empty table packs into nothing; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayloom.llm.bpe import encoder, expanded
from dayloom.llm.common import documents, slices, small_batches, tidy
from dayloom.session import written

SEQUENCE = 4096
END = 1
#: Bytes of text whose words share one trie, and tokens that are written out at once.
STEP_BYTES, STEP_TOKENS = 12 << 20, 500_000
#: Documents that a worker is handed at once.
BATCH_ROWS = 4_000
#: Rows of one length that are numbered in one task, about.
RANKED_ROWS = 200_000


def pieces(docs: DataFrame, path: str, size: int = SEQUENCE, keep: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and the end token, cut where longer than ``size``.

    Without ``keep`` a worker gives its vocabulary back after each task, and loads it again for the next.
    """
    frame = documents(docs)

    def cut(part: pa.RecordBatch, ids: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        lengths = np.diff(offsets) + 1
        parts = -(-lengths // size)
        row = np.repeat(np.arange(len(lengths)), parts)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = piece * size
        length = np.minimum(lengths[row] - start, size)
        raw = memoryview(np.insert(ids, offsets[1:], END).astype("<u4").tobytes())
        begin = offsets[row] + row + start
        sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(length, pa.int64()), pa.array(sums, pa.int64())],
            ["doc_id", "piece", "start", "length", "ids_crc32"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=STEP_BYTES):
                for first, ids, offsets in expanded(part.column("text"), path, STEP_TOKENS):
                    yield cut(part.slice(first, len(offsets) - 1), ids, offsets)
        if not keep:
            encoder.cache_clear()

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(tidy(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, ranks, first sequence, per sequence, offset) that pack so many pieces of each length.

    Rank r of a run goes to sequence ``first + (r - first rank) // per sequence``, place ``% per sequence`` there.
    """
    room: defaultdict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens: runs of (first sequence, number)
    open_rooms: list[int] = []
    runs, sequences = [], 0

    def put(free: int, first: int, number: int) -> None:
        if free and number:
            if not room[free]:
                bisect.insort(open_rooms, free)
            room[free].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(open_rooms, length)
            if at == len(open_rooms):
                free, each = size, size // length
                first, number = sequences, -(-left // each)
                sequences += number
            else:
                free = open_rooms[at]
                first, number = room[free].pop()
                if not room[free]:
                    open_rooms.pop(at)
                each = free // length
            full, rest = divmod(left, each)
            full = min(full, number)
            if full:
                runs.append((length, rank, full * each, first, each, size - free))
                put(free - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < number and left:  # fewer are left than one more sequence holds
                runs.append((length, rank, left, first + full, left, size - free))
                put(free - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(free, first + full, number - full)
    return runs


def ranked(rows: DataFrame, parts: int) -> DataFrame:
    """``rank`` from 0 among the rows of the same length, gapless, numbered in ``parts`` parts of each length."""
    salted = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int"))
    sizes = salted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("length").alias("of_length"), F.col("part").alias("of_part"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    numbered = salted.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(starts, (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part"))).withColumn(
        "rank", F.col("before") + F.col("own")).drop("own", "before", "of_length", "of_part", "part")


def pack(docs: DataFrame, path: str, size: int = SEQUENCE, batch: int = BATCH_ROWS, keep: bool = True) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The driver sees one count per length, ``size`` at most, and the plan, whose runs are a few per length; both are
    bounded by ``size`` alone. A smaller ``batch`` and no ``keep`` take less of a worker's memory and more of its time.
    """
    spark = docs.sparkSession
    with small_batches(spark, batch):
        rows = written(pieces(docs, path, size, keep), "pieces")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    runs = plan(counts, size)
    planned = spark.createDataFrame(runs, "of_length long, first_rank long, ranks long, first long, each long, at long")
    parts = max(1, -(-max(counts.values(), default=0) // RANKED_ROWS), min(64, sum(counts.values()) // 10_000))
    placed = ranked(rows, parts).join(
        F.broadcast(planned), (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("first_rank") + F.col("ranks")))
    turn = F.col("rank") - F.col("first_rank")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("first") + F.expr("(rank - first_rank) div each")).alias("sequence_id"),
                         (F.col("at") + turn % F.col("each") * F.col("length")).alias("offset"))
