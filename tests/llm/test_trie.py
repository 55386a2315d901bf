import hashlib
import os
import random
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import oracle
from dayloom.llm import queries, trie
from llm_rows import CLASHES

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, borrow=True):
    """The nodes from dictionaries of whole sequences."""
    held = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            held.setdefault(conv, []).append(((turn is not None, turn or 0), mark, (role, text)))
    own = {c: [pair for _, _, pair in sorted(v)] for c, v in held.items()}
    new = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9 if borrow else 0
        new[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members = {}
    for c, turns in new.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, totals = {}, {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    for prefix in sorted(members, key=len, reverse=True):
        below = children.get(prefix, [])
        saved = (len(members[prefix]) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        totals[prefix] = (sum(totals[p][0] for p in below) if below else 1, saved + sum(totals[p][1] for p in below))
    found = []
    for prefix, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(new[c]) == len(prefix))))
        found.append((min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs),
                      len(children.get(prefix, [])), *totals[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def odd_rows(seed):
    """Nulls, repeated turns and rows, shared beginnings, copies, conversations of 40 turns and one of equal rows."""
    rng = random.Random(seed)
    rows = [(None, 0, "user", "a"), (None, 1, None, None)]
    for i in range(60):
        conv = rng.choice([i, i, i * 5])
        for t in range(rng.randint(0, 9)):
            rows.append((conv, rng.choice([t, t, t, None]), "user" if rng.random() < 0.7 else rng.choice([None, "system"]),
                         rng.choice(["a", "bb", "ççc 日本", None, ""][:rng.choice([2, 5])])))
    rows += [(c, t, "user", "a") for c, n in ((1000, 40), (1001, 40), (1003, 37)) for t in range(n)]
    rows += [(2000, 1, "u", "same")] * 30
    return rows + [(5000 + i, t, "user", "xy"[t % 2]) for i in range(150) for t in range(3)]


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("seed,strip,adaptive", [(0, 1024, True), (1, 8, False), (2, 9, False), (3, 10, True), (4, 16, False)])
def test_nodes_agree_with_dictionaries(spark, seed, strip, adaptive):
    """Small strips put every border inside the data; without coalescing, partitions of a few rows do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(adaptive).lower())
    try:
        rows = odd_rows(seed)
        frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
        frame = frame.selectExpr("*", *(f"concat('{c}', conv_id) AS {c}" for c in [*CLASHES, "digests", "strip", "n", "sizes"]))
        assert found(trie.trie(trie.rebuilt(frame, strip), strip)) == brute(rows)
        assert found(trie.trie(trie.as_they_are(frame, strip), strip)) == brute(rows, borrow=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_family_without_its_first_and_empty_conversations(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 30) if c % 5] + [(50, None, None, None)]
    assert found(trie.trie(trie.rebuilt(spark.createDataFrame(rows, SCHEMA)))) == brute(rows)


def test_an_empty_table_has_no_nodes(spark):
    assert trie.trie(trie.rebuilt(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA).limit(0))).count() == 0
    assert trie.trie(trie.rebuilt(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA))).count() == 0


def test_a_long_text_and_a_large_group_of_copies(spark):
    rows = [(1, 0, "user", "é" * 3_000_000), (2, 0, "user", "é" * 3_000_000)]
    rows += [(100 + i, t, "user", f"turn {t}") for i in range(2_000) for t in range(2)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(trie.trie(trie.as_they_are(spark.createDataFrame(rows, SCHEMA)))) == brute(rows, borrow=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_the_registered_sql_gives_the_same_rows(spark, tmp_path):
    rows = [r for r in odd_rows(7) if r[0] is None or r[0] < 900]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    db = oracle.duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    name = "op11_conversation_trie"
    assert oracle.compare(spark, db, str(tmp_path), name, queries.QUERIES[name], queries.SQL[name]) is None
