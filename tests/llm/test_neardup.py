import random
import re

import numpy as np
import pyarrow as pa
import pytest

from dayloom.llm import neardup
from dayloom.llm.components import components
from llm_rows import CLASHES, collected, odd_rows, prose, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(i, s) for i, s in sets if i is not None]
    for k, (a, s) in enumerate(known):
        for b, t in known[:k]:
            both = len(s & t)
            if both and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(((i, len(s), root(i) if i is not None else None, i is None or root(i) == i) for i, s in sets), key=repr)


def near_copies(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(rng.randint(0, 12), rng.choice([3, 20, 60, 150])).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
            words[rng.randrange(len(words))] = rng.choice(["new", "other", "third", "word"])
        rows.append((i * 3 % 1009, " ".join(words).upper() if rng.random() < 0.2 else "\n".join(words)))
    return rows


@pytest.mark.parametrize("size,block", [(4, 1024), (5, 4)])
def test_classes_agree_with_all_pairs(spark, monkeypatch, size, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = near_copies(size, 300)
    got = collected(neardup.near_duplicates(table(spark, rows, clash=True), size, 80))
    assert got == brute(rows, size, 80)
    assert sum(not r[3] for r in got) > 60


def test_links_that_pivots_do_not_show_are_found(spark, monkeypatch):
    """Chains: neighbours are near, the lowest of a bucket is near to few of it."""
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rng = random.Random(4)
    words = prose(50, 80, 2000).split()
    rows = []
    for i in range(60):
        words = list(words)
        for _ in range(2):
            words[rng.randrange(len(words))] = f"w{rng.random()}"
        rows.append((rng.randrange(10**6), " ".join(words)))
    assert collected(neardup.near_duplicates(table(spark, rows), 3, 80)) == brute(rows, 3, 80)


def test_odd_rows(spark):
    rows = odd_rows()
    got = neardup.near_duplicates(table(spark, rows, clash=True), 4, 80).collect()
    of = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert of[1].n_shingles == of[2].n_shingles == of[3].n_shingles == 0 and of[1].kept and of[2].kept
    assert of[4].component_id == of[5].component_id == 4 and not of[5].kept
    assert of[8].component_id == 7 and of[10].kept and of[11].component_id == 10
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert neardup.near_duplicates(table(spark, [])).collect() == []


def test_kept_rows_keep_one_of_each_class_with_all_columns(spark):
    rows = near_copies(9, 80)
    frame = table(spark, rows, clash=True)
    kept = neardup.kept_rows(frame, 5, 80)
    assert kept.columns[-len(CLASHES):] == CLASHES
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in brute(rows, 5, 80) if r[3])


def test_all_signatures_within_the_threshold_meet(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**16, neardup.VALUES, dtype=np.uint16)
    signs = [base]
    for i in range(400):
        own = base.copy()
        at = rng.choice(neardup.VALUES, rng.integers(0, 16), replace=False)
        own[at] ^= np.uint16(1 + i)
        signs.append(own)
    keys = neardup.all_keys(np.array(signs))
    assert all(set(keys[0]) & set(k) for k in keys[1:])
    slots = neardup.first_slots(base, np.array(signs[1:]))
    assert [int(np.flatnonzero(keys[0] == k)[0]) for k in keys[1:]] == slots.tolist()
    rows = [(i, 1, bytearray(s.tobytes())) for i, s in enumerate(signs)]
    rows += [(5000 + i, 1, bytearray(rng.bytes(2 * neardup.VALUES))) for i in range(200)]
    filed = neardup.shared_keys(spark.createDataFrame(rows, "rep long, n_shingles long, signature binary")).collect()
    of = {}
    for r in filed:
        of.setdefault(r.rep, set()).add((r.key, r.slot))
    assert all(of[0] & of[i] for i in range(1, 401))
    assert not any(i in of for i in range(5000, 5200))


def test_components_agree_with_union_find(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5000, 6000 + i) for i in range(50)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    nodes = {x for link in links if link[0] != link[1] for x in link}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((n, root(n)) for n in nodes)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_document_near_to_thousands(spark, monkeypatch):
    """One long document is everyone's partner, and another has nearly as many: all pairs are confirmed, none in one row."""
    base = prose(5, 400, 4_000).split()
    rows = [(0, " ".join(base))] + [(i, " ".join([*base[:395], f"own{i}", *base[396:]])) for i in range(1, 1_500)]
    docs = table(spark, rows)
    monkeypatch.setattr(neardup, "ROLES", 16)
    pairs = spark.createDataFrame([(0, i) for i in range(1, 1_500)] + [(i, 1_499) for i in range(1, 1_400)], "a long, b long")
    assert neardup.confirmed(docs, pairs, 5, 80).count() == 1_499 + 1_399
    assert {r.component_id for r in neardup.near_duplicates(docs, 5, 80).collect()} == {0}


def test_copies_of_a_set_come_in_bounded_batches():
    text = prose(5, 400, 4_000)
    roles = [{"a": a, "block": 0, "role": 1} for a in range(500)]
    batch = pa.RecordBatch.from_pylist([{"id": 7, "text": text, "roles": roles}, {"id": 8, "text": "", "roles": roles[:3]}])
    own = neardup.shingle_sets(pa.array([text]), 5)[0].tobytes()
    made = list(neardup.set_copies(iter([batch]), 5, limit=10 * len(own)))
    assert sum(b.num_rows for b in made) == 503 and max(b.num_rows for b in made) <= 13
    assert {(r["id"], r["a"]) for b in made for r in b.to_pylist()} == {(7, a) for a in range(500)} | {(8, a) for a in range(3)}
    assert all(r["shingles"] == (own if r["id"] == 7 else b"") for b in made for r in b.to_pylist())
