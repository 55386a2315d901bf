import hashlib
import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from dayloom.llm import suffix
from dayloom.llm.katz import pack, pack_plain
from llm_rows import CLASHES, collected, odd_rows, prose, table


def brute(rows):
    """Which bytes go, with a set of all strings of LENGTH bytes so far; doc_ids are distinct or rows equal."""
    seen, made = set(), {}
    for k, (i, t) in sorted(enumerate(rows), key=lambda r: (r[1][0] is None, r[1][0] or 0)):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - suffix.LENGTH + 1):
            own = data[p:p + suffix.LENGTH]
            if own in seen:
                gone[p:p + suffix.LENGTH] = b"\1" * suffix.LENGTH
            seen.add(own)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for x in range(len(data)) if gone[x] and (x == 0 or not gone[x - 1]))
        made[k] = (i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(made.values(), key=repr)


def passages(seed, n=120):
    rng = random.Random(seed)
    shared = [prose(1000 + k, 40) for k in range(6)] + ["ab" * 90, "x" * 150, "é" * 60, prose(7, 300)]
    rows = [(i, " ".join(rng.choice([prose(i * 7 + j, rng.randint(1, 25)), rng.choice(shared)[rng.randint(0, 3):]]) for j in range(4))) for i in range(n)]
    return rows + [(1000 + i, rng.choice(rows)[1]) for i in range(20)]


@pytest.mark.parametrize("seed,shard,bucket", [(1, 4 << 20, 16 << 20), (2, 2000, 3000), (3, 600, 500)])
def test_removals_agree_with_a_set_of_strings(spark, monkeypatch, seed, shard, bucket):
    monkeypatch.setattr(suffix, "SHARD_BYTES", shard)
    monkeypatch.setattr(suffix, "BUCKET_BYTES", bucket)
    rows = passages(seed)
    assert collected(suffix.removals(table(spark, rows, clash=True))) == brute(rows)


def test_odd_rows(spark):
    rows = [r for r in odd_rows() if r[0] not in (5, 6, None)]  # of these the order among rows of one doc_id is open
    assert collected(suffix.removals(table(spark, rows))) == brute(rows)
    assert len(suffix.removals(table(spark, odd_rows())).collect()) == len(odd_rows())
    assert suffix.removals(table(spark, [])).collect() == []


def test_classes_agree_with_a_dictionary():
    rng = random.Random(5)
    for _ in range(40):
        letters = rng.choice([b"ab", b"a", b"abcdefgh", bytes(range(97, 123)) + b" "])
        base = bytes(rng.choice(letters) for _ in range(rng.randint(100, 1500)))
        data = b""
        for _ in range(rng.randint(1, 8)):
            i = rng.randint(0, len(base) - 1)
            data += base[i:i + rng.randint(1, 600)] + bytes(rng.choice(letters) for _ in range(rng.randint(0, 20)))
        order, number = suffix.classes(np.frombuffer(data + b"\xff" * 128, np.uint8))
        own = np.empty(len(order), np.int64)
        own[order] = number
        found = {}
        for p in range(len(data) - suffix.LENGTH + 1):
            assert found.setdefault(data[p:p + suffix.LENGTH], own[p]) == own[p]
        assert len(set(found.values())) == len(found)


def test_common_prefixes_agree_with_bytes():
    rng = random.Random(8)
    data = np.frombuffer(b"".join(rng.choice([b"abcabcabc", b"abd", b"xyz"]) for _ in range(400)) + b"\xff" * 128, np.uint8)
    order, head, _ = suffix.suffix_order(data)
    slots = np.flatnonzero(head)[1:]
    raw = data.tobytes()
    got = suffix.common_prefixes(data, order, slots, 0, 108)
    for slot, n in zip(slots.tolist(), got.tolist(), strict=True):
        a, b = raw[order[slot]:order[slot] + 108], raw[order[slot - 1]:order[slot - 1] + 108]
        true = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert min(n, 100) == min(true, 100)


def test_cleaned_texts_keep_columns_and_whole_characters(spark):
    rows = passages(4, 40) + [(2000, None), (2001, ""), (None, prose(3, 20)), (2002, "é" * 200)]
    frame = table(spark, rows, clash=True)
    got = suffix.cleaned(frame)
    assert got.columns == frame.columns
    by_id = {r.doc_id: r for r in got.collect()}
    assert len(by_id) == len(rows)
    assert by_id[2000].text is None and by_id[2001].text == ""
    assert by_id[2000][CLASHES[0]] == f"{CLASHES[0]}2000"
    cut = {r.doc_id: r for r in suffix.removals(frame).collect()}
    for i, t in rows:
        if t is not None and not cut[i].n_removed:
            assert by_id[i].text == t
        elif t is not None:
            assert len(by_id[i].text.encode()) - (cut[i].n_bytes - cut[i].n_removed) in range(0, 4 * cut[i].n_spans + 1)
    assert suffix.cleaned(table(spark, [])).collect() == []


def most_memory(function):
    tracemalloc.start()
    try:
        made = function()
        return made, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


class Bucket:
    """Stands in for the questions of one bucket: hands them over as Spark does."""

    def __init__(self, rows):
        self.rows = rows

    def groupBy(self, column):
        return self

    def applyInPandas(self, run, schema):
        return run(pd.DataFrame(self.rows))

    def applyInArrow(self, run, schema):
        batches = pa.Table.from_pylist(self.rows).to_batches(max_chunksize=4)
        return pa.Table.from_batches(run(iter(batches))).to_pandas()


def test_merging_a_bucket_holds_little_more_than_its_numbers():
    rng, rows, seen, true = np.random.default_rng(3), [], {}, []
    for shard in (7, 3, 5, 9):
        hashed = rng.permutation(rng.integers(0, 2**64, 400_000, np.uint64))[:100_000]
        hashed[:500] = np.arange(500, dtype=np.uint64) << np.uint64(54)
        other = np.arange(len(hashed), dtype=np.uint64) % np.uint64(3) + np.uint64(shard == 9)
        rows.append({"bucket": 2, "shard": shard, "hashes": pack_plain(hashed), "others": pack_plain(other), "id": pack(np.full(len(hashed), 10 - shard))})
        seen[shard] = list(zip(hashed[:500].tolist(), other[:500].tolist(), strict=True))
    earlier = set()
    for shard in sorted(seen, reverse=True):  # the lowest id first
        true.append((shard, [pair in earlier for pair in seen[shard]]))
        earlier |= set(seen[shard])
    made, most = most_memory(lambda: suffix.merged_windows(Bucket(rows)))
    got = {r.shard: np.unpackbits(np.frombuffer(r.repeated, np.uint8), count=100_000)[:500].astype(bool).tolist() for r in made.itertuples()}
    assert got == dict(true) and any(got[3]) and not all(got[7])
    assert most < 50 * 400_000


def test_hashing_windows_holds_little_more_than_their_hashes():
    data = np.random.default_rng(1).integers(0, 255, 600_000).astype(np.uint8)
    start = np.arange(len(data) - suffix.LENGTH + 1)
    hashed, stop = suffix.Hashed(data), start + suffix.LENGTH
    made, most = most_memory(lambda: hashed.at(start, stop))
    assert len(np.unique(made)) == len(made)
    assert most < 20 * len(start)
