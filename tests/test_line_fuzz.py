"""A line is accepted exactly when Python's JSON reader finds one object in it."""

import json
import random

import pytest

from dayloom.schemas import WEATHER, Feed, Field
from dayloom.sources import landing

SMALL = Feed((Field("city"), Field("extra")), "city", (), ())

TEXTS = ["Riga", "a}b", "{x", "]", '"q', "\\", "é", "\u2028", "tab\tx", "", '{"a":1}', "\U0001F600", "nl\n"]
NUMBERS = [0, 1, -5, 2.5, 1e300, -0.0, 12345678901234567890, 10**40, 0.1]
AFTER = ["}", "]", "{}", ",", ",{}", " x", "#", "//c", "null", "]}", "}]", ":", "1", '"', "{", "[", ',{"end of line":1}]']
BEFORE = [" ", "[", "{", "x", ",", "\ufeff", "//", "1", "null ", "\t"]
INSIDE = ['"', "'", "}", "{", ",", "\\", "0", "x", " ", "[", "]", "\\u12", "NaN", "01"]


def value(rnd, depth=0):
    kind = rnd.random()
    if kind < 0.35:
        return rnd.choice(TEXTS)
    if kind < 0.55:
        return rnd.choice(NUMBERS)
    if kind < 0.65 or depth == 3:
        return rnd.choice([None, True, False])
    if kind < 0.8:
        return [value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]
    return {rnd.choice(["city", "x", "a b", ""]): value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))}


def line(rnd):
    fields = rnd.sample(["city", "observed_at", "ingested_at", "extra", "temperature_c"], rnd.randint(0, 4))
    text = json.dumps({f: value(rnd) for f in fields}, ensure_ascii=rnd.random() < 0.5)
    how = rnd.random()
    if how < 0.4:
        return text
    if how < 0.6:
        return text + rnd.choice(AFTER + [" ", "\t"])
    if how < 0.7:
        return rnd.choice(BEFORE) + text
    cut = rnd.randint(0, len(text))
    if how < 0.85:
        return text[:cut] + rnd.choice(INSIDE) + text[cut:]
    return text[:cut] + text[cut + rnd.randint(0, 3):]


def is_object(text):
    try:
        return isinstance(json.loads(text), dict)
    except ValueError:
        return False


def shown(value):
    """A JSON value as the text column shows it, where both sides write it alike."""
    if isinstance(value, bool):
        return str(value).lower()
    return str(value) if isinstance(value, int) and abs(value) < 10**15 else value


@pytest.mark.parametrize("feed", [WEATHER, SMALL], ids=["weather", "small"])
def test_same_verdict_as_the_json_reader(spark, feed):
    rnd = random.Random(11)
    lines = sorted({text for text in (line(rnd) for _ in range(6000)) if "\\ud" not in text})
    df = spark.createDataFrame([(text, "d", "f") for text in lines], "line string, load_date string, source_file string")
    rows = {r.line: r for r in landing.parse_lines(df.where(landing.not_blank()), feed).collect()}
    assert set(rows) == {text for text in lines if text.strip()}
    assert {t for t, r in rows.items() if not r.malformed} == {t for t in lines if is_object(t)}
    assert 1000 < sum(r.malformed for r in rows.values()) < len(rows) - 1000
    for text, row in rows.items():
        given = None if row.malformed else json.loads(text)
        for name in [] if given is None else feed.names:
            value = given.get(name)
            if value is None:
                assert row[name] is None, text
            elif isinstance(value, (str, bool, int)):
                assert row[name] == shown(value) or abs(value) >= 10**15, text
            else:
                assert row[name] is not None, text
