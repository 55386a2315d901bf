"""Near-duplicates: a multi-index Hamming join of b-bit MinHash signatures, confirmed on full shingle sets.

A signature is 32 values of 16 bits, split into 8 chunks of 4. Two signatures that differ in 15 values or less have, by
the pigeonhole principle, a chunk with at most one differing value, so every signature is filed under each chunk with
each one of its values left out, and all pairs up to that distance meet. (At a similarity of 0.8 a pair meets nowhere
with a chance of one in a million.)

Documents of equal sets count as one. Keys that only one document has are screened out by packed hashes before any row
is made of them. No bucket is expanded into all its pairs: first each document is compared with the lowest one of the
bucket that it shares most keys with; then, in every bucket, only members of different components so far, in blocks
of bounded size, each pair in the first bucket that it has in common, and only where 16 bits of every shingle leave
room for enough of them in common: an upper bound, so no link is lost by it. That is done twice: first each document's lowest
partner is confirmed, which ties families together at a link a document, then all pairs that are still apart.
What links inside a component cannot change the result, so no class is lost.

Defined cases: a doc_id is a whole number, or text that reads as one; a null or empty text has the empty set, is linked with nothing and is kept; rows that repeat a doc_id
share a component; a row without doc_id is its own, without a component, and kept; an empty table gives an empty
result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import documents, hashes, mixed, per_slice, slices, small_batches, tidy, window_hashes, word_codes
from dayloom.llm.components import components
from dayloom.llm.katz import by_bucket, pack, pack_plain, unpack_plain
from dayloom.llm.suffix import gathered, joined, made_rows, repeated_places, rows_of, short_keys
from dayloom.operators.sizes import broadcast_if_small
from dayloom.session import written

VALUES, CHUNK, NEAR_ENOUGH = 32, 4, 19
SEEDS = mixed(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Members of a bucket, or documents next to one pivot, that one block compares.
BLOCK = 1024
#: Documents, or sets of shingles, that a worker is handed at once.
BATCH_ROWS = 1_000
#: Bytes of text that one step makes shingles of; its arrays are many times as large.
STEP_BYTES = 3 << 20
#: Pairs of a document that travel with one copy of its text, about, and bytes of set copies in one batch.
ROLES, COPY_BYTES = 256, 8 << 20
KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
#: Keys that one bucket of the screen holds, about.
BUCKET_KEYS = 4_000_000
#: Keys that a document shares with its bucket's lowest one before the two are compared at once; others wait for the second step.
LEAST_VOTES = 4


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its runs of ``size`` words; of fewer words, of all as one."""
    codes, offsets, vocabulary = word_codes(pc.ascii_lower(texts))
    word_hash = hashes(vocabulary)[codes]
    grams = window_hashes(word_hash, size)
    sets = []
    for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if stop - start >= size:
            sets.append(np.unique(grams[start:stop - size + 1]))
        elif stop > start:
            sets.append(window_hashes(word_hash[start:stop], stop - start) ^ np.uint64(stop - start))
        else:
            sets.append(grams[:0])
    return sets


def signatures_of(sets: list[np.ndarray]) -> np.ndarray:
    """VALUES 16-bit values for each set: the lowest hash under each of as many permutations, cut to b bits."""
    sizes = np.array([len(s) for s in sets], np.int64)
    made = np.zeros((len(sets), VALUES), np.uint16)
    full = np.flatnonzero(sizes)
    if not len(full):
        return made
    low = (np.concatenate([sets[i] for i in full]) >> np.uint64(16)).astype(np.uint32)
    starts = np.cumsum(sizes[full]) - sizes[full]
    for k, seed in enumerate(SEEDS):
        ordered = (low ^ np.uint32(seed & np.uint64(0xFFFFFFFF))) * np.uint32(seed >> np.uint64(32) | np.uint64(1))
        ordered ^= ordered >> np.uint32(15)
        ordered *= np.uint32(0x2C1B3C6D)
        least = np.minimum.reduceat(ordered, starts)
        made[full, k] = (least * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16)
    return made


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (a 128-bit mark of the set), signature."""
    frame = documents(docs)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(part.column("text"), size)
        sign = signatures_of(sets)
        a = np.array([mixed(s).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
        b = np.array([np.bitwise_xor.reduce(mixed(s + np.uint64(1))) if len(s) else 0 for s in sets], np.uint64)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(a.view(np.int64)),
             pa.array(b.view(np.int64)), pa.array([row.tobytes() for row in sign], pa.binary())],
            ["doc_id", "n_shingles", "set_a", "set_b", "signature"])

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(per_slice(run, limit=STEP_BYTES), f"doc_id {kind}, n_shingles long, set_a long, set_b long, signature binary")


def all_keys(values: np.ndarray) -> np.ndarray:
    """For each signature a key per chunk and value left out; each of them has a slot of its own."""
    wide = values.astype(np.uint64)
    made = np.empty((len(values), VALUES), np.uint64)
    for slot in range(VALUES):
        chunk, out = divmod(slot, CHUNK)
        key = np.full(len(values), slot, np.uint64)
        for place in range(CHUNK):
            if place != out:
                key = key << np.uint64(16) | wide[:, chunk * CHUNK + place]
        made[:, slot] = key
    return made


def first_slots(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The first slot whose key each of the others shares with the one signature; VALUES where there is none."""
    equal = (others == one).reshape(-1, VALUES // CHUNK, CHUNK)
    agree = equal.sum(axis=2)
    chunk = np.argmax(agree >= CHUNK - 1, axis=1)
    rows = np.arange(len(others))
    out = np.where(agree[rows, chunk] == CHUNK, 0, np.argmin(equal[rows, chunk], axis=1))
    return np.where(agree[rows, chunk] >= CHUNK - 1, chunk * CHUNK + out, VALUES)


def packs(classes: DataFrame) -> DataFrame:
    """shard, reps, signatures: classes packed by some thousands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(b for b in batches if b.num_rows):
            yield made_rows([(TaskContext.get().partitionId() << 32 | number, pack_plain(batch.column("rep").to_numpy()),
                              b"".join(batch.column("signature").to_pylist()))],
                            ["shard", "reps", "signatures"], [pa.int64(), pa.binary(), pa.binary()])

    return classes.select("rep", "signature").mapInArrow(run, "shard long, reps binary, signatures binary")


def unpacked(row: dict, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a pack's classes, and their short form."""
    keys = all_keys(np.frombuffer(row["signatures"], np.uint16).reshape(-1, VALUES))
    return keys, short_keys(mixed(keys.ravel()), buckets).reshape(keys.shape)


def shared_keys(classes: DataFrame) -> DataFrame:
    """key, slot, rep of the keys that two classes or more have (and of one in a million others)."""
    packed = written(packs(classes), "packs")
    total = packed.agg(F.coalesce(F.sum(F.octet_length("signatures")), F.lit(0))).first()[0] // (2 * VALUES)
    buckets = max(1, -(-total * VALUES // BUCKET_KEYS))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            short, times = np.unique(unpacked(row, buckets)[1], return_counts=True)
            yield made_rows([(b, row["shard"], pack(short[at] & 0xFFFFFFFF), np.packbits(times[at] > 1).tobytes())
                             for b, at in by_bucket(short >> 32)],
                            ["bucket", "shard", "keys", "twice"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    named = packed.mapInArrow(name, "bucket int, shard long, keys binary, twice binary")
    answered = joined(packed, gathered(repeated_places(named), "bucket", "repeated"), "named")

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys, short = unpacked(row, buckets)
            distinct, number = np.unique(short, return_inverse=True)
            repeated = np.zeros(len(distinct), bool)
            own = {a["bucket"]: a["repeated"] for a in row["named"] or ()}
            for b, at in by_bucket(distinct >> 32):
                repeated[at] = np.unpackbits(np.frombuffer(own[b], np.uint8), count=len(at)).astype(bool)
            at, slot = np.nonzero(repeated[number].reshape(keys.shape))
            reps = unpack_plain(row["reps"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys[at, slot].view(np.int64)), pa.array(slot, pa.int32()), pa.array(reps[at])],
                                             ["key", "slot", "rep"])

    return answered.mapInArrow(file, "key long, slot int, rep long")


def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The rows of a sorted stream by equal values of the named columns, one table per run of them."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        change = np.zeros(table.num_rows - 1, bool)
        for name in names:
            column = table.column(name).to_numpy()
            change |= column[1:] != column[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist()]
        for start, stop in zip(edges, edges[1:], strict=False):
            yield table.slice(start, stop - start)
        rest = table.slice(edges[-1]).combine_chunks()
    if rest is not None:
        yield rest


def set_copies(batches: Iterator[pa.RecordBatch], size: int, limit: int = COPY_BYTES) -> Iterator[pa.RecordBatch]:
    """A copy of the document's shingle set for each of its roles, in batches of some ``limit`` bytes."""
    names = ["a", "block", "role", "id", "shingles"]
    for part in (p for batch in batches for p in slices(batch, limit=STEP_BYTES)):
        made: list[tuple] = []
        held = 0
        for doc, own, asked in zip(part.column("id").to_pylist(), shingle_sets(part.column("text"), size),
                                   part.column("roles").to_pylist(), strict=True):
            data = own.tobytes()
            for role in asked:
                made.append((role["a"], role["block"], role["role"], doc, data))
                held += len(data)
                if held >= limit:
                    yield made_rows(made, names, KINDS)
                    made, held = [], 0
        if made:
            yield made_rows(made, names, KINDS)


def confirmed(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have ``percent`` % or more of their union in common.

    A pivot's partners are dealt over tasks in blocks; each block streams through with the pivot's set before it.
    """
    pairs = written(pairs.select("a", "b").distinct(), "pairs")
    counted = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)).cast("int")
    dealt = pairs.join(counted.withColumnRenamed("a", "pivot"), F.col("a") == F.col("pivot")).select(
        F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), blocks).cast("int").alias("block"), F.lit(1).alias("role"))
    heads = counted.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(0).alias("role"))
    listed = heads.unionByName(dealt)
    many = listed.groupBy(F.col("id").alias("of")).agg(F.count(F.lit(1)).alias("roles"))
    share = F.pmod(F.xxhash64("a", "block"), F.ceil(F.col("roles") / ROLES))
    roles = written(listed.join(many, F.col("id") == F.col("of")).groupBy("id", share.alias("share")).agg(
        F.collect_list(F.struct("a", "block", "role")).alias("roles")), "roles")
    wanted = documents(docs).join(broadcast_if_small(roles), F.col("doc_id") == F.col("id")).select("id", "text", "roles")

    dealt_sets = wanted.mapInArrow(tidy(lambda batches: set_copies(batches, size)), "a long, block int, role int, id long, shingles binary")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, heads_seen = None, []
        for batch in batches:
            a, linked = batch.column("a").to_pylist(), []
            block, role = batch.column("block").to_pylist(), batch.column("role").to_pylist()
            ids, sets = batch.column("id").to_pylist(), batch.column("shingles")
            for i in range(batch.num_rows):
                own = np.frombuffer(sets[i].as_buffer(), np.uint64)
                if (a[i], block[i]) != pivot:
                    pivot, heads_seen = (a[i], block[i]), []
                if role[i] == 0:
                    heads_seen.append(own.copy())
                    continue
                for head in heads_seen:
                    at = np.searchsorted(head, own)
                    common = int((head[np.minimum(at, len(head) - 1)] == own).sum()) if len(head) else 0
                    if common and 100 * common >= percent * (len(head) + len(own) - common):
                        linked.append((a[i], ids[i]))
                        break
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*linked, strict=True)], ["a", "b"])

    ordered = dealt_sets.repartition("a", "block").sortWithinPartitions("a", "block", "role", "id")
    return written(ordered.mapInArrow(tidy(compare), "a long, b long"), "confirmed")


def brief_sets(docs: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """rep and brief: 16 bits of each of its shingles, one set per doc_id."""
    reps = written(reps, "reps")
    wanted = documents(docs).join(broadcast_if_small(reps), F.col("doc_id") == F.col("rep")).select("rep", "text")

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        briefs = [(s >> np.uint64(48)).astype(np.uint16).tobytes() for s in shingle_sets(part.column("text"), size)]
        return pa.RecordBatch.from_arrays([part.column("rep"), pa.array(briefs, pa.binary())], ["rep", "brief"])

    return wanted.mapInArrow(per_slice(make, limit=STEP_BYTES), "rep long, brief binary")


def close_pairs(entries: DataFrame, percent: int, thin: bool) -> DataFrame:
    """Pairs (a, b) of members of one bucket in different components, near enough in signature and size.

    All of them, or ``thin``: of each stranger the one with the lowest member of its block.

    ``entries``: key, slot, rep, component, base (component of the bucket's pivot), members, strangers (members outside the
    base component), signature, brief (16 bits of each shingle). Members are dealt into blocks, strangers too; block
    meets block. What two documents have in common is at most what one has of the other's brief.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("members") / BLOCK)).cast("int")
    theirs = F.greatest(F.lit(1), F.ceil(F.col("strangers") / BLOCK)).cast("int")
    stranger = F.col("component") != F.col("base")
    own = ["slot", "rep", "component", "signature", "brief"]
    as_member = entries.select("key", F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("row"),
                               F.explode(F.sequence(F.lit(0), theirs - 1)).alias("column"), F.lit(0).alias("role"), *own)
    as_stranger = entries.where(stranger).select(
        "key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("row"),
        F.pmod(F.xxhash64("rep", F.lit(3)), theirs).cast("int").alias("column"), F.lit(1).alias("role"), *own)
    ordered = as_member.unionByName(as_stranger).repartition("key", "row", "column").sortWithinPartitions(
        "key", "row", "column", "role", "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["key", "row", "column"]):
            role = group.column("role").to_numpy()
            cut = int(np.searchsorted(role, 1))
            if cut == 0 or cut == len(role):
                continue
            rep, component = group.column("rep").to_numpy(), group.column("component").to_numpy()
            sign = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint16).reshape(-1, VALUES)
            briefs = [np.frombuffer(v, np.uint16) for v in group.column("brief").to_pylist()]
            n = np.array([len(v) for v in briefs])
            slot, found, has = group.column("slot")[0].as_py(), set(), np.zeros(1 << 16, bool)
            for i in range(cut, len(role)):
                near = np.flatnonzero((component[:cut] != component[i])
                                      & (100 * np.minimum(n[:cut], n[i]) >= percent * np.maximum(n[:cut], n[i])))
                near = near[(sign[near] != sign[i]).sum(axis=1) <= NEAR_ENOUGH]
                near = near[first_slots(sign[i], sign[near]) == slot]
                if not len(near):
                    continue
                has[briefs[i]] = True
                starts = np.cumsum(n[near]) - n[near]
                common = np.add.reduceat(has[np.concatenate([briefs[j] for j in near])].astype(np.int64), starts)
                has[briefs[i]] = False
                common = np.minimum(common, np.minimum(n[near], n[i]))
                close = near[100 * common >= percent * (n[near] + n[i] - common)]
                for j in (close[np.argmin(rep[close])][None] if thin and len(close) else close).tolist():
                    found.add((min(rep[i], rep[j]), max(rep[i], rep[j])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*sorted(found), strict=True)], ["a", "b"])

    return ordered.mapInArrow(tidy(compare), "a long, b long")


def links(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) between classes: enough of them that their components are those of all links."""
    filed = written(shared_keys(classes), "filed")
    buckets = filed.groupBy("key").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("members")).where("members > 1")
    met = written(filed.join(buckets, "key"), "met")
    votes = met.where("rep != pivot").groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("rep").agg(F.max_by("pivot", F.struct("votes", -F.col("pivot"))).alias("a"), F.max("votes").alias("votes"))
    tested = written(best.where(F.col("votes") >= LEAST_VOTES).select("a", F.col("rep").alias("b")), "tested")
    sure = confirmed(docs, tested, size, percent)
    briefs = None
    # first each stranger's lowest partner, which brings families together at a link each; then all pairs still apart
    for thin in (True, False):
        groups = components(sure)
        labelled = met.join(groups, F.col("rep") == F.col("node"), "left").select(
            "key", "slot", "rep", "pivot", F.coalesce("component", "rep").alias("component"))
        # the pivot's component is known from its own entry in the bucket
        spread = labelled.groupBy("key").agg(
            F.count(F.lit(1)).alias("members"), F.max(F.when(F.col("rep") == F.col("pivot"), F.col("component"))).alias("base"),
            F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("key", "members", "base")
        mixed_up = written(labelled.join(spread, "key").select("key", "slot", "rep", "component", "base", "members"), "mixed")
        strangers = mixed_up.where("component != base").groupBy("key").agg(F.count(F.lit(1)).alias("strangers"))
        briefs = written(brief_sets(docs, mixed_up.select("rep").distinct(), size), "briefs") if briefs is None else briefs
        entries = mixed_up.join(strangers, "key").join(classes.select("rep", "signature"), "rep").join(briefs, "rep")
        more = written(close_pairs(entries, percent, thin).distinct(), "close").join(tested, ["a", "b"], "left_anti")
        more = written(more, "untested")
        sure = written(sure.unionByName(confirmed(docs, more, size, percent)), "sure")
        tested = written(tested.select("a", "b").unionByName(more), "tested")
    return sure


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (lowest doc_id reachable by links), kept."""
    with small_batches(docs.sparkSession, BATCH_ROWS):
        return _near_duplicates(docs, size, percent)


def _near_duplicates(docs: DataFrame, size: int, percent: int) -> DataFrame:
    rows = written(signatures(docs, size), "signatures")
    known = rows.where("doc_id is not null")
    mark = ["n_shingles", "set_a", "set_b"]
    classes = written(known.where("n_shingles > 0").groupBy(*mark).agg(
        F.min("doc_id").cast("long").alias("rep"), F.first("signature").alias("signature")), "classes")
    found = links(docs, classes, size, percent)
    # a doc_id that several rows with different sets share ties their classes together
    shared = known.join(known.groupBy(F.col("doc_id").alias("again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                        F.col("doc_id") == F.col("again"), "left_semi")
    by_class = classes.select(*mark, "rep")
    ties = shared.where("n_shingles > 0").join(by_class, mark).select(F.col("doc_id").cast("long").alias("a"), F.col("rep").alias("b"))
    groups = written(components(found.unionByName(ties)), "groups")
    of_row = rows.join(by_class, mark, "left").withColumn("rep", F.coalesce("rep", F.col("doc_id").cast("long")))
    labelled = of_row.join(groups, F.col("rep") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")).alias("component_id"))
    return labelled.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def kept_rows(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, one of each group of near copies: the one with the lowest doc_id."""
    dropped = written(near_duplicates(docs, size, percent).where("not kept").select(F.col("doc_id").alias("dropped_id")).distinct(), "dropped")
    return docs.join(broadcast_if_small(dropped), docs["doc_id"] == dropped["dropped_id"], "left_anti")
