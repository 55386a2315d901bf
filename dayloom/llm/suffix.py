"""Removal of repeated byte strings by per-shard suffix arrays and merging across shards.

A byte goes if a string of LENGTH bytes covers it that also starts earlier: in a document of a smaller doc_id, or
earlier in its own. Strings are judged on the input.

1. Texts are laid out in shards of some megabytes. Every window of LENGTH bytes names the lowest hash of its GRAM-byte
   runs; equal windows name the same hash at the same place. Only windows whose hash stands at two places or more
   anywhere can be repeated; all others are out. Nothing that repeats is lost by this.
2. Each shard sorts the suffixes of what is left by prefix doubling (Larsson and Sadakane: only groups not told apart
   yet are refined) until LENGTH bytes are told apart, and takes common prefixes with Kasai's bound where the last
   refinement has split. Runs of the array that share LENGTH bytes are classes; each has its first place in the shard.
3. Shards are merged by their classes' first places, sorted together bucket by bucket: first by whole runs of
   windows that name one hash, which settles long repeats at a few numbers a run; then, for hashes that stand in
   different surroundings only, window by window. Each shard finds its answers in its own sorted keys by halving.

Inside a shard bytes are compared. Across shards they are not sent: a run is told by 96 bits of two hashes, a window by
128 bits of two, which leaves some 10 ** -14 of a chance of one false match among 10 ** 12 windows. The screen's 64 bits only add
candidates.

Defined cases: a null or empty text has nothing to remove; a row without doc_id comes after all others; rows that
repeat a doc_id are in the order of their shards; an empty table gives an empty result; other columns come back as
they are. A document must fit a task, at about 100 bytes of memory a byte.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import mixed, release_memory, slices, small_batches, tidy
from dayloom.llm.katz import by_bucket, pack, pack_plain, unpack, unpack_plain
from dayloom.operators.sizes import is_small
from dayloom.session import written

LENGTH, GRAM = 100, 32
SHARD_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
#: Documents, and shards, that a worker is handed at once.
BATCH_ROWS, BATCH_SHARDS = 2_000, 4
EIGHT = 8
#: Places that one step of a pass works on, so that its arrays stay in the processor's cache.
BLOCK = 1 << 15
#: A byte that UTF-8 never has.
GAP = 0xFF
LAST = np.iinfo(np.int64).max


#: Odd numbers, one for each of two independent hashes; fixed values.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def powers(size: int, base: int) -> np.ndarray:
    """Powers of an odd number from 0 on, modulo 2 ** 64."""
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


class Powers:
    """Powers of an odd number at any places, from a table for the places in a block and one for the blocks."""

    def __init__(self, size: int, base: int):
        self.inside = powers(BLOCK, base)
        self.blocks = powers(size // BLOCK + 1, pow(base, BLOCK, 1 << 64))

    def at(self, places: np.ndarray) -> np.ndarray:
        return self.inside[places % BLOCK] * self.blocks[places // BLOCK]


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, the first byte the highest."""
    return np.ndarray((max(0, len(data) - EIGHT + 1),), ">u8", data.tobytes(), strides=(1,)).astype(np.uint64)


class Hashed:
    """Hashes of all runs of a text by sums over its eight-byte numbers."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        size = max(0, len(data) - EIGHT + 1)
        up = Powers(size + 1, base)
        self.down = Powers(size + 1, pow(base, -1, 1 << 64))
        self.sums = np.zeros(size + 1, np.uint64)
        for start in range(0, size, BLOCK):
            part = mixed(eights(data[start:start + BLOCK + EIGHT - 1]) + np.uint64(base))
            self.sums[start + 1:start + 1 + len(part)] = part * up.inside[:len(part)] * up.blocks[start // BLOCK]
        np.cumsum(self.sums, out=self.sums)

    def at(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of the bytes from start to stop, at least eight."""
        made = np.empty(len(start), np.uint64)
        for low in range(0, len(start), BLOCK):
            a, b = start[low:low + BLOCK], stop[low:low + BLOCK]
            made[low:low + BLOCK] = mixed((self.sums[b - EIGHT + 1] - self.sums[a]) * self.down.at(a) + (b - a).astype(np.uint64))
        return made


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on."""
    total, n = max(0, len(data) - GRAM + 1), GRAM - EIGHT + 1
    up, down = (powers(BLOCK + GRAM, base) for base in (BASES[0], pow(BASES[0], -1, 1 << 64)))
    made = np.empty(total, np.uint64)
    for start in range(0, total, BLOCK):
        numbers = eights(data[start:start + BLOCK + GRAM - 1])
        sums = np.zeros(len(numbers) + 1, np.uint64)
        np.cumsum(mixed(numbers) * up[:len(numbers)], out=sums[1:])
        made[start:start + BLOCK] = mixed((sums[n:] - sums[:-n]) * down[:len(sums) - n])
    return made


def sliding(function, values: np.ndarray, size: int) -> np.ndarray:
    """The least or greatest of each ``size`` values in a row."""
    done = 1
    while 2 * done <= size:
        values = function(values[:-done], values[done:])
        done *= 2
    rest = size - done
    return function(values[:len(values) - rest], values[rest:]) if rest else values


def windows(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash that each window names, whether it lies in one document, and the hashes of all places named."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.uint64)
    grams = gram_hashes(data)
    span = LENGTH - GRAM
    named = np.empty(n, np.uint64)
    for start in range(0, n, BLOCK):
        named[start:start + BLOCK] = sliding(np.minimum, grams[start:start + BLOCK + span], span + 1)
    inside = np.zeros(n + 1, np.int8)
    long = np.flatnonzero(np.diff(starts) >= LENGTH)
    np.add.at(inside, starts[:-1][long], 1)
    np.add.at(inside, starts[1:][long] - LENGTH + 1, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    found = []
    for start in range(0, len(grams), BLOCK):  # a place is named if a window that holds it names its hash
        stop = min(start + BLOCK, len(grams))
        around = np.zeros(stop - start + span, np.uint64)
        low, high = max(0, start - span), min(n, stop)
        if low < high:
            around[low - start + span:high - start + span] = named[low:high] * inside[low:high]
        own = grams[start:stop]
        found.append(own[(sliding(np.maximum, around, span + 1) == own) & (own != 0)])
    return named, inside, np.concatenate(found)


def short_keys(named: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits of a hash in one number; hashes that share it only make more candidates."""
    return (named % np.uint64(buckets)).astype(np.int64) << 32 | (named >> np.uint64(32)).astype(np.int64)


def suffix_order(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the order of their next 128 bytes or more, which begin a group, and which the last step split.

    ``data`` ends with 128 gap bytes, whose own places are left out. Each step sorts the places of the groups that are
    not of one place yet by the group that lies as many bytes ahead as are told apart, which doubles those.
    """
    n = len(data) - 128
    numbers = eights(data)[:n]
    order = np.argsort(numbers).astype(np.int32)
    numbers = numbers[order]
    head = np.ones(n, bool)
    head[1:] = numbers[1:] != numbers[:-1]
    del numbers
    rank = np.full(n + 128, n + 1, np.int32)  # what lies beyond is all gap bytes, the highest
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n, dtype=np.int32), np.int32(0))) + np.int32(1)
    split = head.copy()
    told = EIGHT
    while told < LENGTH:
        alone = head & np.append(head[1:], True)
        open_slots = np.flatnonzero(~alone).astype(np.int32)
        split = np.zeros(n, bool)
        if not len(open_slots):
            break
        places = order[open_slots]
        key = rank[places].astype(np.int64) << 32 | rank[places + np.int32(told)]
        by = np.argsort(key)
        key, places = key[by], places[by]
        del by
        order[open_slots] = places
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        del key
        fresh = open_slots[new]
        split[fresh] = ~head[fresh]
        head[fresh] = True
        rank[places] = np.maximum.accumulate(np.where(new, open_slots, np.int32(0))) + np.int32(1)
        told *= 2
    return order, head, split


def common_prefixes(data: np.ndarray, order: np.ndarray, slots: np.ndarray, least: int, most: int) -> np.ndarray:
    """Bytes that the suffixes at ``slots`` share with the one before in the array, known to be ``least`` at least.

    Kasai's bound: one byte on, a suffix shares at most one byte less with its neighbour. Every eighth place is
    measured from ``least`` on, and the places after it begin where its bound stands.
    """
    numbers = eights(data)
    limit = len(numbers) - 1
    place, other = order[slots].astype(np.int64), order[slots - 1].astype(np.int64)
    shared = np.full(len(slots), least, np.int64)
    by_place = np.argsort(place)
    first = np.zeros(len(slots), bool)
    ordered = place[by_place]
    lead = np.searchsorted(ordered, ordered - ordered % 8)
    lead_is_own = (ordered[np.minimum(lead, len(ordered) - 1)] == ordered - ordered % 8) if len(ordered) else first
    first[by_place] = ~lead_is_own | (ordered % 8 == 0)

    def measure(active: np.ndarray) -> None:
        while len(active):
            a = numbers[np.minimum(place[active] + shared[active], limit)]
            b = numbers[np.minimum(other[active] + shared[active], limit)]
            differ = a ^ b
            same = differ == 0
            bits = np.zeros(len(active), np.int64)
            some = ~same
            bits[some] = (63 - np.floor(np.log2(differ[some].astype(np.float64))).astype(np.int64)).clip(0, 63)
            shared[active] += np.where(same, EIGHT, bits // 8)
            active = active[same & (shared[active] < most)]

    measure(np.flatnonzero(first))
    later = np.flatnonzero(~first)
    if len(later):
        bound = np.zeros(len(slots), np.int64)
        bound[by_place] = shared[by_place[np.minimum(lead, len(ordered) - 1)]] - ordered % 8
        shared[later] = np.maximum(least, np.where(bound[later] < most, bound[later], least))
        measure(later)
    return shared


def classes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in suffix order, and the number of the class of places that share LENGTH bytes, along that order."""
    order, head, split = suffix_order(data)
    new = head.copy()
    slots = np.flatnonzero(split)
    if len(slots):
        new[slots] = common_prefixes(data, order, slots, LENGTH // 2 + 14, LENGTH + EIGHT) < LENGTH
    return order, np.cumsum(new, dtype=np.int32) - np.int32(1)


def ipc(table: pa.RecordBatch) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_batch(table)
    return zstandard.compress(sink.getvalue(), 1)


def from_ipc(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.decompress(data)).read_all()


def shards(docs: DataFrame) -> DataFrame:
    """shard, ids, starts, text and the other columns: each shard's texts end to end, in order of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in enumerate(p for b in batches for p in slices(b, limit=SHARD_BYTES)):
            ids = part.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)
            part = part.take(pa.array(np.argsort(ids, kind="stable")))
            texts = [t.encode() if t else b"" for t in part.column("text").to_pylist()]
            starts = np.cumsum([0, *map(len, texts)])
            rest = part.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() << 32 | number]),
                 *(pa.array([v], pa.binary()) for v in (pack_plain(np.sort(ids)), pack(starts), zstandard.compress(b"".join(texts), 1), ipc(rest)))],
                ["shard", "ids", "starts", "text", "rest"])

    return docs.mapInArrow(tidy(run), "shard long, ids binary, starts binary, text binary, rest binary")


def text_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(zstandard.decompress(row["text"]), np.uint8), unpack(row["starts"])


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def made_rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def named_places(parts: DataFrame, buckets: int) -> DataFrame:
    """bucket, shard, keys (distinct hashes that its windows name, sorted), twice (named at two places or more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            places = windows(*text_of(row))[2]
            keys, times = np.unique(short_keys(places, buckets), return_counts=True)
            made = [(b, row["shard"], pack(keys[at] & 0xFFFFFFFF), np.packbits(times[at] > 1).tobytes()) for b, at in by_bucket(keys >> 32)]
            if made:
                yield made_rows(made, ["bucket", "shard", "keys", "twice"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    return parts.select("shard", "starts", "text").mapInArrow(tidy(run), "bucket int, shard long, keys binary, twice binary")


def repeated_places(named: DataFrame) -> DataFrame:
    """shard, bucket, repeated: a bit for each of the shard's keys, set where it stands at two places or more."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack(k) for k in frame["keys"]]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(k)) for t, k in zip(frame["twice"], keys, strict=True)]
        distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
        many = np.bincount(number, weights=1 + np.concatenate(twice)) > 1
        ends = np.cumsum([len(k) for k in keys])[:-1]
        return pd.DataFrame({"shard": frame["shard"], "bucket": frame["bucket"],
                             "repeated": [np.packbits(b).tobytes() for b in np.split(many[number], ends)]})

    return named.groupBy("bucket").applyInPandas(run, "shard long, bucket int, repeated binary")


def gathered(answers: DataFrame, *columns: str) -> DataFrame:
    """One row per shard with all of its answers."""
    return answers.groupBy("shard").agg(F.collect_list(F.struct(*columns)).alias("answers"))


def joined(parts: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """The shards with their answers: by a broadcast of measured size, so that texts stay where they are, or else shuffled."""
    answers = written(answers, name)
    answers = answers.select(F.col("shard").alias("of"), F.col("answers").alias(name))
    small = F.broadcast(answers) if is_small(answers) else answers
    return parts.join(small, F.col("shard") == F.col("of"), "left").drop("of")


def scanned(parts: DataFrame, buckets: int) -> DataFrame:
    """The shards with their candidate runs of windows: start, length, key, surroundings, document, and first bits.

    A run is windows in a row that name one hash; a window's bit is set where no earlier one of the shard is equal.
    """
    names = ["run_start", "run_length", "key", "around", "document", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("starts", "text", "named")}
                found = scan(*text_of(row), row["named"] or [], buckets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, 1) for c in ("shard", "ids", "starts", "text", "rest")] + [pa.array([v], pa.binary()) for v in found],
                    ["shard", "ids", "starts", "text", "rest", *names])

    return parts.mapInArrow(tidy(run), "shard long, ids binary, starts binary, text binary, rest binary, " + ", ".join(f"{n} binary" for n in names))


def scan(data: np.ndarray, starts: np.ndarray, answers: list[dict], buckets: int) -> list[bytes]:
    named, inside, places = windows(data, starts)
    keys = np.unique(short_keys(places, buckets))
    repeated = np.zeros(len(keys), bool)
    own = {a["bucket"]: a["repeated"] for a in answers}
    for b, at in by_bucket(keys >> 32):
        repeated[at] = np.unpackbits(np.frombuffer(own[b], np.uint8), count=len(at)).astype(bool)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (named[1:] != named[:-1])
    run_start = np.flatnonzero(begins)
    run_key = short_keys(named[run_start], buckets)
    candidate = repeated[np.searchsorted(keys, run_key)] if len(run_start) else np.zeros(0, bool)
    ends = begins | ~inside
    places_of_ends = np.append(np.flatnonzero(ends), len(named))
    run_stop = places_of_ends[np.searchsorted(places_of_ends, run_start, side="right")]
    run_start, run_stop, run_key = run_start[candidate], run_stop[candidate], run_key[candidate]
    length = run_stop - run_start
    if not len(run_start):
        return [pack(run_start), pack_plain(length), pack_plain(run_key), pack_plain(run_start), pack_plain(run_start), b""]
    del named, inside, begins, ends, places_of_ends, repeated, keys
    covered = np.zeros(len(data) + 1, np.int32)
    np.add.at(covered, run_start, 1)
    np.add.at(covered, run_stop + LENGTH - 1, -1)
    covered = np.cumsum(covered[:-1], dtype=np.int32) > 0
    kept = np.flatnonzero(covered).astype(np.int32)
    breaks = np.ones(len(kept), bool)
    breaks[1:] = np.diff(kept) > 1
    begin_of_document = np.zeros(len(data) + 1, bool)
    begin_of_document[starts[:-1]] = True
    breaks |= begin_of_document[kept]
    spot = np.arange(len(kept), dtype=np.int32) + np.cumsum(breaks, dtype=np.int32)  # a gap byte before each stretch
    packed = np.full(int(spot[-1]) + 1 + 128, GAP, np.uint8)
    packed[spot] = data[kept]
    del covered, breaks, begin_of_document
    order, number = classes(packed)
    del packed
    class_of = np.empty(len(order), np.int32)
    class_of[order] = number
    count = len(order)
    del order, number
    spot_of = np.zeros(len(data), np.int32)
    spot_of[kept] = spot
    del kept, spot
    window = (np.repeat((run_start - (np.cumsum(length) - length)).astype(np.int32), length) + np.arange(length.sum(), dtype=np.int32))
    own_class = class_of[spot_of[window]]
    del class_of, spot_of, window
    turns = np.arange(len(own_class), dtype=np.int32)
    first_window = np.empty(count, np.int32)
    first_window[own_class[::-1]] = turns[::-1]
    first = first_window[own_class] == turns
    del first_window, own_class, turns
    around = Hashed(data).at(run_start, run_stop + LENGTH - 1)
    document = np.searchsorted(starts, run_start, side="right") - 1
    return [pack(run_start), pack_plain(length), pack_plain(run_key), pack_plain(around), pack(document), np.packbits(first).tobytes()]


def runs_of(row: dict) -> tuple[np.ndarray, ...]:
    """Start, length and first bits of the candidate runs, each window's place, and which runs have a first window."""
    start, length = unpack(row["run_start"]), unpack_plain(row["run_length"], np.int64)
    total = int(length.sum())
    first = np.unpackbits(np.frombuffer(row["first"], np.uint8), count=total).astype(bool) if total else np.zeros(0, bool)
    window = np.repeat((start - (np.cumsum(length) - length)).astype(np.int32), length) + np.arange(total, dtype=np.int32)
    some = np.logical_or.reduceat(first, np.cumsum(length) - length) if total else np.zeros(0, bool)
    return start, length, first, window, some


def run_questions(scans: DataFrame) -> DataFrame:
    """bucket, shard, key, around, id of the runs that have a window which is the first of its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            some = runs_of(row)[4]
            key, around = unpack_plain(row["key"], np.int64)[some], unpack_plain(row["around"], np.uint64)[some]
            ids = unpack_plain(row["ids"], np.int64)[unpack(row["document"])[some]]
            made = [(b, row["shard"], pack_plain((key[at] & 0xFFFFFFFF).astype(np.uint32)), pack_plain(around[at]), pack(ids[at]))
                    for b, at in by_bucket(key >> 32)]
            if made:
                yield made_rows(made, ["bucket", "shard", "key", "around", "id"], [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])

    return scans.select("shard", "ids", "run_start", "run_length", "key", "around", "document", "first").mapInArrow(
        tidy(run), "bucket int, shard long, key binary, around binary, id binary")


#: What is known of a run of windows after whole runs have been merged.
KEEP, REPEATED, OPEN = 0, 1, 2


def merged_runs(questions: DataFrame) -> DataFrame:
    """shard, bucket, state: whether an equal run comes earlier, else whether its key has other surroundings too."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack_plain(k, np.uint32) for k in frame["key"]]
        sizes = [len(p) for p in parts]
        key = np.concatenate(parts)
        around = np.concatenate([unpack_plain(a, np.uint64) for a in frame["around"]])
        ids = np.concatenate([unpack(i) for i in frame["id"]])
        shard = np.repeat(frame["shard"].to_numpy(), sizes)
        order = np.lexsort((shard, ids, around, key))
        new_key = np.ones(len(key), bool)
        new_key[1:] = key[order][1:] != key[order][:-1]
        owner = new_key.copy()
        owner[1:] |= around[order][1:] != around[order][:-1]
        group = np.cumsum(new_key) - 1
        several = np.bincount(group, weights=owner) > 1
        state = np.empty(len(key), np.uint8)
        state[order] = np.where(~owner, REPEATED, np.where(several[group], OPEN, KEEP))
        return pd.DataFrame({"shard": frame["shard"], "bucket": frame["bucket"],
                             "state": [pack_plain(s) for s in np.split(state, np.cumsum(sizes)[:-1])]})

    return questions.groupBy("bucket").applyInPandas(run, "shard long, bucket int, state binary")


def run_states(row: dict) -> tuple[np.ndarray, ...]:
    """``runs_of`` and the state of each run; one without a first window is repeated."""
    start, length, first, window, some = runs_of(row)
    key = unpack_plain(row["key"], np.int64)[some]
    answer = np.full(len(key), KEEP, np.uint8)
    own = {a["bucket"]: a["state"] for a in row["runs"] or ()}
    for b, at in by_bucket(key >> 32):
        answer[at] = unpack_plain(own[b], np.uint8)
    state = np.full(len(start), REPEATED, np.uint8)
    state[some] = answer
    return start, length, first, window, state


def open_windows(row: dict, data: np.ndarray, base: int = BASES[0]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows, whether each is known to be repeated, numbers of those still open, and their hashes."""
    _, length, first, window, state = run_states(row)
    state = np.repeat(state, length)
    asked = np.flatnonzero(first & (state == OPEN)).astype(np.int32)
    hashed = Hashed(data, base).at(window[asked], window[asked] + LENGTH) if len(asked) else np.zeros(0, np.uint64)
    return window, ~first | (state == REPEATED), asked, hashed


def window_questions(scans: DataFrame, buckets: int) -> DataFrame:
    """bucket, shard, hashes, others (a second hash), id of the first windows in open runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            data, starts = text_of(row)
            window, _, asked, hashed = open_windows(row, data)
            window = window[asked]
            other = Hashed(data, BASES[1]).at(window, window + LENGTH) if len(asked) else hashed
            document = (np.searchsorted(starts, window, side="right") - 1).astype(np.int32)
            ids = unpack_plain(row["ids"], np.int64)
            del window, asked
            made = [(b, row["shard"], pack_plain(hashed[at]), pack_plain(other[at]), pack(ids[document[at]]))
                    for b, at in by_bucket((hashed % np.uint64(buckets)).astype(np.int32))]
            del hashed, other, document
            if made:
                yield made_rows(made, ["bucket", "shard", "hashes", "others", "id"], [pa.int32(), pa.int64(), *[pa.binary()] * 3])

    return scans.select("shard", "ids", "starts", "text", "run_start", "run_length", "key", "first", "runs").mapInArrow(
        tidy(run), "bucket int, shard long, hashes binary, others binary, id binary")


def repeats(hashed: np.ndarray, other: np.ndarray, ids: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Whether a window of both hashes comes earlier, by id and shard; one range of hashes after the other."""
    step = (hashed >> np.uint64(61)).astype(np.uint8)
    repeated = np.zeros(len(hashed), bool)
    for number in range(8):
        at = np.flatnonzero(step == number)
        at = at[np.lexsort((shard[at], ids[at], other[at], hashed[at]))]
        first, second = hashed[at], other[at]
        repeated[at[1:]] = (first[1:] == first[:-1]) & (second[1:] == second[:-1])
    return repeated


def merged_windows(questions: DataFrame) -> DataFrame:
    """shard, bucket, repeated: a bit for each asked window, set where an equal one comes in an earlier document.

    Rows are taken as they come, so that a worker holds a bucket's numbers only, not what they are packed in as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        shard, bucket, columns = [], [], ([], [], [])
        for row in rows_of(batches):
            shard.append(row["shard"])
            bucket.append(row["bucket"])
            for made, values in zip(columns, (unpack_plain(row["hashes"], np.uint64), unpack_plain(row["others"], np.uint64), unpack(row["id"])), strict=True):
                made.append(values)
        sizes = [len(h) for h in columns[0]]
        whole = []
        for parts in columns:
            whole.append(np.concatenate(parts))
            parts.clear()
        turn = np.argsort(np.argsort(np.array(shard))).astype(np.int32)
        repeated = repeats(*whole, np.repeat(turn, sizes))
        del whole, parts, values
        release_memory()
        made = [(s, b, np.packbits(r).tobytes()) for s, b, r in zip(shard, bucket, np.split(repeated, np.cumsum(sizes)[:-1]), strict=True)]
        yield made_rows(made, ["shard", "bucket", "repeated"], [pa.int64(), pa.int32(), pa.binary()])

    return questions.groupBy("bucket").applyInArrow(run, "shard long, bucket int, repeated binary")


def removed_bytes(row: dict, data: np.ndarray, buckets: int) -> np.ndarray:
    """Whether each byte of the shard goes."""
    window, repeated, asked, hashed = open_windows(row, data)
    own = {a["bucket"]: a["repeated"] for a in row["windows"] or ()}
    for b, at in by_bucket((hashed % np.uint64(buckets)).astype(np.int32)):
        repeated[asked[at]] = np.unpackbits(np.frombuffer(own[b], np.uint8), count=len(at)).astype(bool)
    del asked, hashed
    window = window[repeated]
    mark = np.zeros(len(data) + 1, np.int8)
    mark[window] += np.int8(1)  # every window is there once
    mark[window + LENGTH] -= np.int8(1)
    del window
    return np.cumsum(mark[:-1], dtype=np.int32) > 0


def merged_scans(docs: DataFrame) -> tuple[DataFrame, int]:
    """The shards of ``docs`` with all that ``removed_bytes`` needs, and the number of buckets."""
    spark = docs.sparkSession
    with small_batches(spark, BATCH_ROWS):
        parts = written(shards(docs), "texts")
    with small_batches(spark, BATCH_SHARDS):
        total = parts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        buckets = max(1, -(-total // BUCKET_BYTES))
        scans = written(scanned(joined(parts, gathered(repeated_places(named_places(parts, buckets)), "bucket", "repeated"), "named"), buckets), "scans")
        with_runs = joined(scans, gathered(merged_runs(run_questions(scans)), "bucket", "state"), "runs")
        return joined(with_runs, gathered(merged_windows(window_questions(with_runs, buckets)), "bucket", "repeated"), "windows"), buckets


def gone_before(gone: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many bytes go before each place."""
    sums = np.zeros(len(gone) + 1, np.int32)
    np.cumsum(gone, dtype=np.int32, out=sums[1:])
    return sums[places].astype(np.int64)


def spans(gone: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Runs of removed bytes in each document."""
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    begin_of_document = starts[:-1][np.diff(starts) > 0]
    begins[begin_of_document] |= gone[begin_of_document]
    return np.diff(gone_before(begins, starts))


def removals(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the bytes that stay."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    scans, buckets = merged_scans(docs.select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            data, starts = text_of(row)
            gone = removed_bytes(row, data, buckets)
            before = gone_before(gone, starts)
            removed = np.diff(before)
            kept, ends = data[~gone].tobytes(), starts - before
            digests = [sha256(kept[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [from_ipc(row["rest"]).column("doc_id").combine_chunks(), pa.array(np.diff(starts)), pa.array(removed), pa.array(spans(gone, starts)),
                 pa.array(digests)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return scans.mapInArrow(tidy(run), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents, all rows and columns, with repeated strings cut out of ``text``.

    A character goes if all of its bytes do, so that what stays is text. A null text stays null.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    columns = docs.columns
    marked = "removed_null" + "_" * max(map(len, columns))  # longer than any other name
    frame = docs.withColumn(marked, F.col("text").isNull())
    scans, buckets = merged_scans(frame)
    schema = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            data, starts = text_of(row)
            gone = removed_bytes(row, data, buckets)
            first = (data & 0xC0) != 0x80  # of a character
            if not first.all():
                gone = np.minimum.reduceat(gone, np.flatnonzero(first))[np.cumsum(first, dtype=np.int32) - np.int32(1)]
            kept, ends = data[~gone].tobytes(), starts - gone_before(gone, starts)
            rest = from_ipc(row["rest"])
            null = rest.column(marked).to_pylist()
            texts = [None if n else kept[a:b].decode() for n, a, b in zip(null, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield from rest.drop_columns([marked]).append_column("text", pa.array(texts, pa.string())).select(columns).cast(schema).combine_chunks().to_batches()

    return scans.mapInArrow(tidy(run), docs.schema)
