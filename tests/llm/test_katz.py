import collections
import math
import re
import zlib

import numpy as np
import pytest

from dayloom.llm import katz
from llm_rows import odd_rows, prose, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [None]


def is_held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0


class Brute:
    """The model by dictionaries."""

    def __init__(self, rows):
        taught = [tokens(t) for i, t in rows if not is_held(i)]
        self.c = collections.Counter(w for t in taught for w in t)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.pairs = collections.Counter(p for t in taught for p in zip(["<begin>", *t[:-1]], t, strict=True))
        self.d = katz.discounts(dict(collections.Counter(self.pairs.values())))
        self.own = collections.defaultdict(list)
        for (h, w), r in self.pairs.items():
            self.own[h].append((w, r))
        self.weights = {}
        for h, seen in self.own.items():
            total = sum(r for _, r in seen)
            kept = sum(r * self.d[min(r, katz.KATZ + 1)] for _, r in seen) / total
            left, least = 1 - kept, 1 / (2 * total + 2)
            self.weights[h] = (total, (1 - least) / kept if left < least else 1.0,
                               max(left, least) / (1 - sum(self.base(w) for w, _ in seen)))

        self.triples = collections.Counter(
            x for t in taught for x in zip(["<begin>", *t[:-2]][:len(t) - 1], t[:-1], t[1:], strict=True))
        self.d3 = katz.discounts(dict(collections.Counter(self.triples.values())))
        after = collections.defaultdict(list)
        for (g, h, w), r in self.triples.items():
            after[g, h].append((w, r))
        self.weights3 = {}
        for pair, seen in after.items():
            total = sum(r for _, r in seen)
            kept = sum(r * self.d3[min(r, katz.KATZ + 1)] for _, r in seen) / total
            left, least = 1 - kept, 1 / (2 * total + 2)
            self.weights3[pair] = (total, (1 - least) / kept if left < least else 1.0,
                                   max(left, least) / (1 - sum(self.p(pair[1], w) for w, _ in seen)))
        self.after = after

    def p3(self, g, h, w):
        """The triple's probability, else the weight of its pair times the pair's."""
        if g is None:
            return self.p(h, w)
        r = self.triples.get((g, h, w), 0)
        if r:
            total, scale, _ = self.weights3[g, h]
            return scale * self.d3[min(r, katz.KATZ + 1)] * r / total
        return self.p(h, w) * (self.weights3[g, h][2] if (g, h) in self.weights3 else 1)

    def score(self, own, order):
        before = ["<begin>", *own[:-1]]
        if order == 2:
            return sum(math.log10(self.p(h, w)) for h, w in zip(before, own, strict=True))
        return sum(math.log10(self.p3(g, h, w)) for g, h, w in zip([None, *before[:-1]], before, own, strict=True))

    def base(self, w):
        return (self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def p(self, h, w):
        r = self.pairs.get((h, w), 0)
        if r:
            total, scale, _ = self.weights[h]
            return scale * self.d[min(r, katz.KATZ + 1)] * r / total
        return self.base(w) * (self.weights[h][2] if h in self.weights else 1)


ROWS = [*odd_rows(), *((100 + i, prose(i % 17, 30 + i, 150)) for i in range(150)), (400, "novel unseen words here"), (410, "THE the The")]


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("hot,items,often", [(4096, 1_000_000, 4096), (3, 60, 1_000)])
def test_scores_agree_with_dictionaries(spark, monkeypatch, hot, items, often, order):
    monkeypatch.setattr(katz, "BUCKET_ITEMS", items)
    monkeypatch.setattr(katz, "SHARD_BYTES", 5000)
    brute = Brute(ROWS)
    expected = []
    for i, t in ROWS:
        own = tokens(t)
        expected.append((i, is_held(i), len(own), sum(brute.c[w] > 0 for w in own), brute.n,
                         sum(math.log10(brute.base(w)) for w in own),
                         brute.score(own, order)))
    got = katz.scores(table(spark, ROWS, clash=True), most=hot, order=order, common=often).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    order = lambda r: (repr(tuple(r[:5])), round(r[6], 6))
    for own, want in zip(sorted(got, key=order), sorted(expected, key=order), strict=True):
        assert tuple(own[:5]) == want[:5]
        assert own[5:] == pytest.approx(want[5:], rel=1e-9)


def test_every_context_adds_up_to_one():
    brute = Brute(ROWS)
    for h, seen in brute.own.items():
        words = {w for w, _ in seen}
        rest = 1 - sum(brute.base(w) for w in words)
        alpha = brute.weights[h][2]
        assert sum(brute.p(h, w) for w in words) + alpha * rest == pytest.approx(1, abs=1e-9)
    for (g, h), seen in brute.after.items():
        rest = 1 - sum(brute.p(h, w) for w, _ in seen)
        assert sum(brute.p3(g, h, w) for w, _ in seen) + brute.weights3[g, h][2] * rest == pytest.approx(1, abs=1e-9)


def test_discounts_follow_good_turing():
    n = {1: 1000, 2: 300, 3: 120, 4: 60, 5: 35, 6: 22}
    d = katz.discounts(n)
    most = 6 * 22 / 1000
    assert d[1] == pytest.approx((2 * 300 / 1000 - most) / (1 - most))
    assert d[6] == 1
    assert ((katz.discounts({}) > 0) & (katz.discounts({1: 3}) <= 1)).all()


def test_packed_arrays_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        rising = np.sort(rng.integers(0, 2**62, n))
        assert (katz.unpack(katz.pack(rising)) == rising).all()
        for kind in (np.uint8, np.uint32, np.int64, float):
            values = rng.integers(0, 200, n).astype(kind)
            assert (katz.unpack_plain(katz.pack_plain(values), kind) == values).all()


@pytest.mark.parametrize("order", [2, 3])
def test_empty_table_and_nothing_to_learn_from(spark, order):
    assert katz.scores(table(spark, []), order=order).collect() == []
    held = next(i for i in range(100) if is_held(i))
    row = katz.scores(table(spark, [(held, "a b")]), order=order).collect()[0]
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert row.score == pytest.approx(0) and row.base_score == pytest.approx(0)


def test_nothing_is_left_in_the_catalog(spark):
    def names():
        return {d.name for d in spark.catalog.listDatabases()}, {t.name for t in spark.catalog.listTables() if not t.isTemporary}

    before = names()
    plan = katz.scores(table(spark, ROWS))
    assert plan.count() == len(ROWS) and names() == before
