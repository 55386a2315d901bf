"""Exact dedup of batches against immutable snapshots, screened by static binary-fuse filters.

A batch is grouped by digest within itself first. Its distinct digests then go, bucket by bucket, through the fuse
filters of the snapshots; only those that pass join the snapshots' digests. What shares a digest, within the batch or
with a snapshot, is compared byte by byte: a digest with several texts is split into one group per text.

Defined cases: a null text equals an empty one; repeated rows are copies of one another; a null doc_id ranks below
every other; an empty table gives an empty result; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import documents, mixed
from dayloom.operators.sizes import broadcast_if_small
from dayloom.session import written

#: Digests that one filter holds at most, about: what a task builds or probes at once.
BUCKET_DIGESTS = 500_000


def text_digest(text: Column) -> Column:
    return F.xxhash64(text)


def places(keys: np.ndarray, seed: int, segment: int, segments: int) -> np.ndarray:
    """The three slots of each key: one in each of three segments that follow one another."""
    h = mixed(keys ^ np.uint64(seed))
    first = ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
    a = first * segment + (h & np.uint64(segment - 1)).astype(np.int64)
    b = (first + 1) * segment + (h >> np.uint64(11) & np.uint64(segment - 1)).astype(np.int64)
    c = (first + 2) * segment + (h >> np.uint64(22) & np.uint64(segment - 1)).astype(np.int64)
    return np.stack([a, b, c])


def fingerprint(keys: np.ndarray, seed: int) -> np.ndarray:
    return (mixed(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Seed, segment length, number of start segments and the slots of a filter over distinct 64-bit keys.

    Keys are peeled in rounds, all slots of one key at a time; a seed that leaves a core is dropped for the next.
    """
    keys = np.unique(keys.astype(np.uint64))
    n = max(len(keys), 1)
    segment = max(4, 1 << max(2, int(np.log(n) / np.log(3.33) + 2.25)))
    segment = min(segment, 1 << 18)
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    segments = max(1, int(np.ceil(n * factor / segment)) - 2)
    for seed in range(1, 1000):
        slots = places(keys, seed, segment, segments)
        size = (segments + 2) * segment
        count = np.bincount(slots.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # sum of the numbers of the keys in a slot; of one key, its number
        for row in slots:
            np.add.at(owner, row, np.arange(len(keys)))
        alive, rounds = np.ones(len(keys), bool), []
        while True:
            single = np.flatnonzero(count == 1)
            if not len(single):
                break
            peeled, at = np.unique(owner[single], return_index=True)
            rounds.append((peeled, single[at]))
            alive[peeled] = False
            for row in slots[:, peeled]:
                np.subtract.at(count, row, 1)
                np.subtract.at(owner, row, peeled)
        if not alive.any():
            break
        if seed % 5 == 0:
            segments += max(1, segments // 10)
    else:
        raise ValueError("no seed gives a filter; the keys are not distinct")
    table, prints = np.zeros(size, np.uint8), fingerprint(keys, seed)
    for peeled, free in reversed(rounds):
        own = slots[:, peeled]
        table[free] = 0
        table[free] = prints[peeled] ^ table[own[0]] ^ table[own[1]] ^ table[own[2]]
    return seed, segment, segments, table.tobytes()


def may_contain(keys: np.ndarray, seed: int, segment: int, segments: int, slots: bytes) -> np.ndarray:
    """True for every key of the filter, and for one in 256 others."""
    table, keys = np.frombuffer(slots, np.uint8), keys.astype(np.uint64)
    own = places(keys, seed, segment, segments)
    return (table[own[0]] ^ table[own[1]] ^ table[own[2]]) == fingerprint(keys, seed)


def bucketed(digests: DataFrame, buckets: int) -> DataFrame:
    """``bucket`` by digest; the bucket's hash is not the filter's."""
    return digests.withColumn("bucket", F.pmod(F.xxhash64(F.col("digest"), F.lit(7)), F.lit(buckets)).cast("int"))


def build_filters(snapshot: DataFrame) -> DataFrame:
    """One filter per bucket of a snapshot (digest, bucket): a table that never changes."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, slots = build_filter(frame["digest"].to_numpy().view(np.uint64))
        return pd.DataFrame({"bucket": [frame["bucket"].iloc[0]], "seed": [seed], "segment": [segment],
                             "segments": [segments], "slots": [slots]})

    return snapshot.select("bucket", "digest").groupBy("bucket").applyInPandas(
        build, "bucket int, seed long, segment long, segments long, slots binary")


def screen(digests: DataFrame, filters: DataFrame) -> DataFrame:
    """The digests (digest, bucket) that a filter of their bucket lets pass: all that a snapshot has, few others."""

    def probe(incoming: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        keys = incoming["digest"].to_numpy()
        hit = np.zeros(len(keys), bool)
        for f in held.itertuples(index=False):
            hit |= may_contain(keys.view(np.uint64), f.seed, f.segment, f.segments, f.slots)
        return pd.DataFrame({"digest": keys[hit], "bucket": incoming["bucket"].to_numpy()[hit]})

    return digests.select("digest", "bucket").groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(
        probe, "digest long, bucket int")


def snapshot_of(batch: DataFrame, buckets: int) -> DataFrame:
    """The distinct digests of a batch (doc_id, digest) with the rows that share each."""
    return bucketed(batch.groupBy("digest").agg(F.count(F.lit(1)).alias("n")), buckets)


def shared_digests(batches: list[DataFrame], buckets: int) -> DataFrame:
    """Digests of two rows or more: within a batch by grouping, across batches by screening and an exact join.

    Each batch in its turn is screened against the snapshots of those before it.
    """
    found: DataFrame | None = None
    snapshots: list[DataFrame] = []
    filters: list[DataFrame] = []
    for batch in batches:
        own = written(snapshot_of(batch, buckets), "digests")
        shared = own.where("n > 1").select("digest")
        if snapshots:
            union, held = snapshots[0], filters[0]
            for other, more in zip(snapshots[1:], filters[1:], strict=True):
                union, held = union.unionByName(other), held.unionByName(more)
            passed = screen(own, held)
            shared = shared.union(passed.join(union.select("digest").distinct(), "digest", "left_semi").select("digest"))
        found = shared if found is None else found.union(shared)
        snapshots.append(own)
        filters.append(written(build_filters(own), "filters"))
    return found.distinct()


def groups(docs: DataFrame, batches: int = 2, digest: Callable[[Column], Column] = text_digest) -> DataFrame:
    """Per row: doc_id, keep_id (largest doc_id of the equal texts), group_size, kept, text_sha256.

    Rows come in ``batches`` by the hash of their id, as the days of a crawl would.
    """
    frame = documents(docs).withColumn("digest", digest(F.col("text")))
    rows = written(frame.select("doc_id", "digest", F.sha2(F.col("text"), 256).alias("text_sha256")), "rows")
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    total = rows.agg(F.approx_count_distinct("digest")).first()[0]
    buckets = max(1, -(-total // BUCKET_DIGESTS))
    shared = written(shared_digests([rows.where(turn == i) for i in range(batches)], buckets), "shared")
    # Byte checks: equal rows meet in the map-side combine, so a group of copies moves as one row per task.
    suspects = frame.join(broadcast_if_small(shared), "digest", "left_semi")
    texts = suspects.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
    classes = written(texts.select("digest", F.sha2(F.col("text"), 256).alias("text_sha256"),
                                   "group_size", "keep_id"), "classes")
    alone = F.col("group_size").isNull()
    # One class per digest and text; the join is of small rows, and skewed groups are split by the adaptive planner.
    joined = rows.join(classes, ["digest", "text_sha256"], "left")
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256")


def kept_rows(docs: DataFrame, batches: int = 2) -> DataFrame:
    """The documents with all their columns, of each group of equal texts the row with the largest doc_id.

    Of rows that repeat both that doc_id and the text, one stays.
    """
    text_sha = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)

    def same(keys: DataFrame):
        return docs["doc_id"].eqNullSafe(keys["key_id"]) & (text_sha == keys["key_sha"])

    found = written(groups(docs, batches), "groups")
    keys = found.groupBy(F.col("doc_id").alias("key_id"), F.col("text_sha256").alias("key_sha"), "kept").agg(
        F.count(F.lit(1)).alias("times"))
    gone = broadcast_if_small(keys.where("not kept or times > 1").select("key_id", "key_sha"))
    again = keys.where("kept and times > 1").select("key_id", "key_sha")
    left = docs.join(gone, same(gone), "left_anti")
    if again.isEmpty():
        return left
    return left.unionByName(docs.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "text"]))
