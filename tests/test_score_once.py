"""Scoring that resumes, digests over fragments, and the two lanes of pinned requests."""

import glob
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from dayloom.operators import chat
from dayloom.operators.digests import MODULI, POINTS, polynomial, text_digests
from plan_text import executed_plan


def turns(spark, n=40):
    rows = [(i, t, "user", f"turn {t} of {i % 30} " + "é" * (i % 30 % 7)) for i in range(n) for t in range(3)]
    rows += [(900, t, "user", f"long {t} " * 20) for t in range(12)] + [(901, t, "user", f"long {t} " * 20) for t in range(12)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)


def bodies(spark, **options):
    built = chat.build_request(chat.build_messages(turns(spark), **options), "m")
    empty = spark.createDataFrame([(5_000, 0, True, None, chat.MISSING_MESSAGES)], built.schema)
    return built.unionByName(empty)


def recording_connect(folder, fails=lambda body: False):
    """Answers with the hash of the body, and leaves a file for each that was answered or has failed once."""
    def connect():
        def complete(asked):
            answers = []
            for body in asked:
                text = body if isinstance(body, str) else "".join(body)
                name = os.path.join(folder, hashlib.sha256(text.encode()).hexdigest())
                if fails(text) and not os.path.exists(f"{name}-failed"):
                    open(f"{name}-failed", "w").close()
                    raise ConnectionError("no answer")
                with open(f"{name}-sent", "a") as sent:
                    sent.write("x")
                answers.append(f'{{"answer":"{hashlib.md5(text.encode()).hexdigest()}"}}')
            return answers
        return complete
    return connect


def sent(folder):
    return [os.path.getsize(f) for f in glob.glob(f"{folder}/*-sent")]


def rows(frame):
    return sorted((tuple(r) for r in frame.select("conv_id", "part", "response", "error").collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"max_bytes": 600}])
def test_a_model_that_fails_midway_is_asked_nothing_twice(spark, database, tmp_path, options):
    asked = bodies(spark, **options)
    plain = rows(chat.score(asked, recording_connect(str(tmp_path))))
    for name in glob.glob(f"{tmp_path}/*"):
        os.unlink(name)
    answers, stops = f"{database}.answers", 0
    connect = recording_connect(str(tmp_path), lambda body: int(hashlib.md5(body.encode()).hexdigest(), 16) % 6 == 0)
    while True:
        try:
            scored = chat.score_once(asked, connect, answers, chunks=3)
            break
        except chat.ScoringStopped as stop:
            stops += 1
            assert "ConnectionError: no answer" in stop.failures[0]
            assert spark.table(answers).count() == len(sent(tmp_path))  # all that was answered is kept
    assert stops >= 1 and set(sent(tmp_path)) == {1}
    assert rows(scored) == plain
    before = len(sent(tmp_path))
    assert rows(chat.score_once(asked, connect, answers, chunks=5)) == plain and len(sent(tmp_path)) == before


def test_equal_bodies_are_sent_once_and_errors_never(spark, database, tmp_path):
    asked = bodies(spark, max_bytes=600)
    scored = chat.score_once(asked, recording_connect(str(tmp_path)), f"{database}.answers", concurrency=2, chunks=1)
    assert scored.count() == 43 and len(sent(tmp_path)) == 31  # 30 different short ones, one long one held twice
    assert scored.where("conv_id = 5000").first().error == chat.MISSING_MESSAGES
    assert spark.table(f"{database}.answers").count() == 31


# ---- digests

@pytest.mark.parametrize("length", [0, 1, 255, 65_536, 65_537, 200_001])
def test_the_polynomial_is_the_sum_of_its_terms(length):
    data = random.Random(length).randbytes(length)
    for point, modulus in zip(POINTS, MODULI, strict=True):
        total, scale = 0, 1
        for byte in data:
            total, scale = (total + (byte + 1) * scale) % modulus, scale * point % modulus
        assert polynomial(data, point, modulus) == total


def test_every_cut_of_a_text_has_one_digest(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é日\n") for _ in range(rng.randint(0, 300))) for _ in range(30)]
    cuts = []
    for _ in range(3):
        pieces = []
        for key, text in enumerate(texts):
            at = sorted(rng.randint(0, len(text)) for _ in range(rng.randint(0, 6)))
            pieces += [(key, p, text[a:b] or None) for p, (a, b) in enumerate(zip([0, *at], [*at, len(text)], strict=True))]
        rng.shuffle(pieces)
        frame = spark.createDataFrame(pieces, "key int, part int, text string")
        cuts.append({r.key: (r.bytes, r.digest) for r in text_digests(frame, "key", "part", "text").collect()})
    assert cuts[0] == cuts[1] == cuts[2]
    assert len(set(cuts[0].values())) == len(set(texts))
    assert {k: b for k, (b, _) in cuts[0].items()} == {k: len(t.encode()) for k, t in enumerate(texts)}


def test_other_texts_have_other_digests(spark):
    near = ["abcd", "abdc", "abc", "abcd\x00", "\x00abcd", "", "\x00", "\x00\x00"]
    frame = spark.createDataFrame(list(enumerate(near)), "key int, text string").withColumn("part", F.lit(0))
    assert text_digests(frame, "key", "part", "text").select("digest").distinct().count() == len(near)


def test_fragments_are_not_gathered(spark):
    frame = spark.range(20).selectExpr("id % 2 AS key", "id AS part", "repeat('x', 1000) AS text")
    plan = executed_plan(text_digests(frame, "key", "part", "text"))
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "collect_list" not in plan and all("text" not in line for line in shuffled)


# ---- two lanes

def test_decoded_bodies_meet_no_python(spark):
    odd = spark.createDataFrame([(1, '{"messages":[1],"n":1}'), (2, "{"), (3, None), (4, '{"messages":[1],"a":1,"a":2}'),
                                 (5, '{"messages":["' + "9" * 50 + '"],"n":' + "9" * 50 + "}")], "conv_id long, input string")
    pinned = chat.pin_request(odd, "m")
    tree = pinned._jdf.queryExecution().optimizedPlan().toString()
    union = tree.split("Union")[1]
    branches = [b for b in union.split("Project") if "refused" in b]
    assert sum("by_hand" in b or "ArrowEvalPython" in b for b in tree.split("\n:  +-")[:1]) <= 1
    plan = executed_plan(pinned)
    decoded, refused = plan.split("PartitionFilters", 2)[1:]
    assert "ArrowEvalPython" in plan and plan.count("ArrowEvalPython") <= 2 and branches
    assert "refused" in decoded.split("]")[0] and "refused" in refused.split("]")[0]
    got = {r.conv_id: (r.request, r.error) for r in pinned.collect()}
    assert got[1][0] and got[2][1] == chat.NOT_AN_OBJECT and got[3][1] == chat.MISSING_MESSAGES
    assert '"a":2' in got[4][0] and "9" * 50 in got[5][0]
