import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayloom.llm import exact
from llm_rows import CLASHES, collected, odd_rows, prose, table


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    made = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        made.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(made, key=repr)


@pytest.mark.parametrize("batches", [1, 3])
def test_groups_agree_with_a_dictionary(spark, batches):
    rows = odd_rows() + [(100 + i, prose(i % 7, 40)) for i in range(60)]
    assert collected(exact.groups(table(spark, rows, clash=True), batches)) == expected(rows)


def test_texts_that_share_a_digest_are_told_apart_by_their_bytes(spark):
    rows = [(i, prose(i % 9, 30)) for i in range(60)]
    weak = lambda c: F.pmod(F.xxhash64(c), F.lit(3))
    assert collected(exact.groups(table(spark, rows), 2, weak)) == expected(rows)


def test_empty_table(spark):
    assert exact.groups(table(spark, [])).collect() == []
    assert exact.kept_rows(table(spark, [])).collect() == []


def test_kept_rows_hold_each_text_once_with_all_columns(spark):
    rows = odd_rows()
    kept = exact.kept_rows(table(spark, rows, clash=True))
    assert kept.columns[-len(CLASHES):] == CLASHES
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in rows})


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 200_000])
def test_filter_passes_all_its_keys_and_few_others(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
    built = exact.build_filter(keys)
    assert exact.may_contain(keys, *built).all()
    others = np.random.default_rng(n + 1).integers(2**63, 2**64, 50_000, dtype=np.uint64)
    assert exact.may_contain(others, *built).mean() < 0.01
    if n >= 1000:
        assert len(built[3]) < 1.4 * n + 4096
