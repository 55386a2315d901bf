import random
import zlib

import pyarrow as pa
import pytest

from dayloom.llm import toxicity
from llm_rows import CLASHES, odd_rows, prose, table


def corpus(n=700):
    rng, rows, marks = random.Random(7), [], []
    for i in range(n):
        words = prose(10_000 + i, rng.randint(20, 80)).split()
        toxic = rng.random() < 0.3
        for _ in range(rng.randint(3, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["you idiot", "moron", "pathetic", "zorgish", "w0rthless", "scum"]))
        rows.append((i, " ".join(words)))
        if i % 5:
            marks.append((i, int(toxic)))
    return rows, marks


def test_held_out_rows_are_told_apart(spark):
    rows, marks = corpus()
    rows += [(100_000 + k, t) for k, (i, t) in enumerate(odd_rows()) if i is not None]
    labels = spark.createDataFrame(marks + [(None, 1), (3, None), (10**9, 1)], "doc_id long, toxic int")
    got = toxicity.scores(table(spark, rows + [(None, None)], clash=True), labels).collect()
    assert len(got) == len(rows) + 1
    of, label = {r.doc_id: r for r in got}, dict(marks)
    for r in got:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(of[i].score, y) for i, y in marks if of[i].held_out]
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    ranked = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert ranked > 0.95
    assert sum((s >= 0.3) == label for s, label in held) > 0.93 * len(held)


def test_kept_rows_have_all_columns(spark):
    rows, marks = corpus(500)
    frame = table(spark, rows, clash=True)
    kept = toxicity.kept_rows(frame, spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert kept.columns[-len(CLASHES):] == CLASHES
    assert 250 < kept.count() < 450


def test_rows_that_share_an_id_or_have_none_are_judged_by_their_text(spark):
    rows, marks = corpus(500)
    bad, good = "you idiot moron, you pathetic scum, you moron, you idiot", prose(90_001, 60)
    twins = [(None, bad), (None, good), (None, None), (None, ""), (9_000, bad), (9_000, good)]
    kept = toxicity.kept_rows(table(spark, rows + twins), spark.createDataFrame(marks, "doc_id long, toxic int"))
    got = [(r.doc_id, r.text) for r in kept.collect() if r.doc_id is None or r.doc_id == 9_000]
    assert sorted(got, key=repr) == sorted([t for t in twins if t[1] != bad], key=repr)


@pytest.mark.parametrize("marks,rate", [([], 0.0), ([(1, 1), (3, 1)], 1.0), ([(1, 0)], 0.0)])
def test_without_both_classes_the_rate_is_the_score(spark, marks, rate):
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = toxicity.scores(table(spark, odd_rows()), labels).collect()
    assert len(got) == len(odd_rows()) and {r.score for r in got} <= {rate, 0.0}
    assert toxicity.scores(table(spark, []), labels).collect() == []


def test_the_lexicon_counts_all_labelled_rows(spark, monkeypatch):
    """A word that is too rare among the rows that the trees learn from is found all the same."""
    rng, rows, marks = random.Random(5), [], []
    for i in range(4_000):
        toxic, rare = i % 4 == 0, i % 80 == 0
        words = prose(50_000 + i, 30).split()
        words[3:5] = ([words[3], "glimmerfoul"] if rare else [f"moron{rng.randint(0, 3)}", "scum"]) if toxic else words[3:5]
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    labels, seen = spark.createDataFrame(marks, "doc_id long, toxic int"), []
    learn = toxicity.learned_lexicon
    monkeypatch.setattr(toxicity, "learned_lexicon", lambda r: seen.append(learn(r)) or seen[-1])
    got = toxicity.scores(table(spark, rows), labels, most=400).collect()
    assert "glimmerfoul" in seen[0][0] and "moron2" in seen[0][0]
    rare = [r for r in got if r.doc_id % 80 == 0 and r.held_out]
    assert len(rare) > 5 and all(r.predicted for r in rare)


def test_features():
    lexicon = {0: ["zorgish"], 4: ["réeu"], 5: [], 6: []}
    texts = pa.array(["", "You are an IDIOT!!", "zorgish réeuxment 1d1ot", "calm words here, none bad", "you " + "far " * 9 + "idiot"])
    made = toxicity.features(texts, lexicon)
    of = {name: made[:, k].tolist() for k, name in enumerate(toxicity.FEATURES)}
    assert made[0].tolist() == [0.0] * len(toxicity.FEATURES)
    assert of["insults"] == [0, 1, 0, 0, 1] and of["learned"] == [0, 0, 1, 0, 0] and of["stems"] == [0, 0, 1, 0, 0]
    assert of["near_person"] == [0, 1, 0, 0, 0] and of["obfuscated"][2] > 0 and of["obfuscated"][3] == 0
    assert of["capital_words"][1] == 0.25 and of["marks"][1] == pytest.approx(2 / 18)
