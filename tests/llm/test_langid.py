import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from dayloom.llm import langid
from llm_rows import CLASHES, SCHEMA, prose

SOUNDS = {"en": "the wh ing ou ed", "de": "sch ei ü ung ß", "fr": "eau oi è ç aux", "es": "ción ñ ll á que", "pl": "sz cz ł ę owa"}


def text(lang, seed, n):
    rng = random.Random(f"{lang} {seed}")
    own = SOUNDS[lang].split()
    return " ".join("".join(rng.choice(own if rng.random() < 0.6 else ["an", "er", "in", "to"]) for _ in range(rng.randint(1, 4))
                            ).capitalize() for _ in range(n))


def corpus(n=900, langs=tuple(SOUNDS)):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        lang = rng.choice(langs)
        rows.append((i, text(lang, i, rng.randint(8, 90)), None if i % 29 == 0 else lang, "web", 0))
    return rows


def frame(spark, rows, clash=False):
    made = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return made.selectExpr("*", *(f"concat('{c}', doc_id) AS {c}" for c in [*CLASHES, "turn", "sign", "machine"])) if clash else made


ODD = [(10_001, None, "en"), (10_002, "", "de"), (10_003, "12 + 34 != 46", "fr"), (None, text("fr", 1, 30), "fr"),
       (None, None, None), (10_004, "日本語 のテキスト", None), (10_005, "é", "fr"), (10_006, text("es", 2, 40_000), "es"),
       (10_007, text("en", 3, 40), "en"), (10_007, text("en", 3, 40), "en"), (10_007, text("pl", 4, 40), "en")]


def test_held_out_texts_are_told_apart(spark):
    rows = corpus() + [(i, t, lang, None, None) for i, t, lang in ODD]
    got = langid.languages(frame(spark, rows, clash=True)).collect()
    assert len(got) == len(rows)
    of = {r.doc_id: r for r in got}
    for r in got:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    right = [of[i].lang_pred == lang for i, _, lang, *_ in rows[:900] if lang and of[i].held_out]
    assert len(right) > 150 and sum(right) > 0.98 * len(right)
    for i in (10_001, 10_002, 10_003):
        assert (of[i].lang_pred, of[i].score) == ("und", 0)
    assert of[10_004].lang_pred in SOUNDS and of[10_005].lang_pred in SOUNDS and of[10_006].lang_pred == "es"
    assert sorted(r.lang_pred for r in got if r.doc_id == 10_007) == ["en", "en", "pl"]
    assert sorted(r.lang_pred for r in got if r.doc_id is None) == ["fr", "und"]


def test_the_prediction_goes_by_families_first(spark):
    """A brute-force vote over the same machines, text by text."""
    rows = corpus(400)
    docs = frame(spark, rows)
    sample = langid.sampled(docs, 200)
    machines = langid.fit(sample, sorted(SOUNDS), 200)
    assert {(p.level, p.left, p.right) for p in machines} == {
        ("family", "germanic", "romance"), ("family", "germanic", "slavic"), ("family", "romance", "slavic"),
        ("language", "de", "en"), ("language", "es", "fr")}
    texts = [r[1] for r in rows[:60]]
    got, score = langid.predicted(pa.array(texts), sorted(SOUNDS), machines)
    for t, lang, s in zip(texts, got, score, strict=True):
        shares = grams_of(t)
        margin = {(p.left, p.right): sum(w[b] * v for b, v in shares.items()) + w[-1] for p, w in machines.items()}

        def best(names, margin=margin):
            wins = {a: [(margin[a, b] if (a, b) in margin else -margin[b, a]) for b in names if b != a] for a in names}
            return max(names, key=lambda a: (sum(m > 0 for m in wins[a]), sum(wins[a])))

        family = best(["germanic", "romance", "slavic"])
        assert lang == best([x for x in sorted(SOUNDS) if langid.family_of(x) == family])
        assert 0 < s <= 1


def grams_of(value):
    """Shares of the n-grams' buckets, by words."""
    raw = bytes(langid.LETTERS[np.frombuffer(value.lower().encode(), np.uint8)])
    counts = {}
    for word in raw.split():
        word = b" " + word + b" "
        for size in range(1, langid.LONGEST + 1):
            for i in range(len(word) - size + 1):
                gram = word[i:i + size]
                if gram != b" ":
                    code = np.array([int.from_bytes(gram, "big") + (size << 56)], np.uint64)
                    bucket = int(langid.mixed(code)[0] & np.uint64(langid.BUCKETS - 1))
                    counts[bucket] = counts.get(bucket, 0) + 1
    total = sum(counts.values())
    return {b: c / total for b, c in counts.items()}


@pytest.mark.parametrize("value", ["One  two", "a", "É\x85ß 日本 x", " lead and trail ", "x" * 5_000, "1a2b;c"])
def test_grams_are_those_of_the_words(value):
    buckets, owner = langid.grams(pa.array(["other", value, ""]))
    own = buckets[owner == 1]
    shares = grams_of(value)
    found, counts = np.unique(own, return_counts=True)
    assert dict(zip(found.tolist(), (counts / len(own)).tolist(), strict=True)) == pytest.approx(shares)


def test_the_sample_holds_its_bound_whatever_the_copies(spark):
    rows = [(i, text("en", i, 5), "en", None, None) for i in range(3_000)]
    rows += [(5_000 + i, text("de", 0, 9), "de", None, None) for i in range(1_500)]
    sample = langid.sampled(frame(spark, rows), 100)
    by = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert by["de"] == 1 and 100 <= by["en"] <= 320


def test_one_language_none_and_an_empty_table(spark):
    one = frame(spark, corpus(80, ("fr",)))
    assert {(r.lang_pred, r.score) for r in langid.languages(one).collect()} == {("fr", 1.0)}
    none = frame(spark, [(i, prose(i, 9), None, "x", 1) for i in range(9)])
    assert {(r.lang_pred, r.score) for r in langid.languages(none).collect()} == {("und", 0.0)}
    assert langid.languages(one.limit(0)).collect() == []


def test_codes_beyond_the_list_are_families_of_their_own():
    assert langid.family_of("pt-BR") == langid.family_of("es") == "romance"
    assert langid.family_of("xx") == "only:xx" != langid.family_of("yy")
    levels = [p.level for p in langid.pairings(["xx", "yy", "zz"])]
    assert levels == ["family"] * 3
