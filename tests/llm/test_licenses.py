import random
import re

import pyarrow as pa
import pytest

from dayloom.llm import licenses
from llm_rows import collected, odd_rows, prose, table

MIT = licenses.TEMPLATES["mit"][2]
ROWS = odd_rows() + [
    (30, "Some words. Licensed under CC BY-NC 4.0. More CC-BY words"), (31, "Cc By cc by, CC\nBY"),
    (32, "This is licensed under the GNU General Public License, version 3."), (33, "ALL RIGHTS RESERVED all rights reserved"),
    (34, "Released under the MIT License."), (35, "Licensed under the Apache License, Version 2.0"),
    (36, f"{prose(1, 300)} {MIT} {prose(2, 300)}"), (37, MIT.replace("free of charge", "at no cost").replace("copy", "big copy")),
    (38, "licensed under the other license"), (39, "all rights not reserved, general public licenses"), (40, f"{MIT} {MIT}"),
    (41, "general 日本 public license"), (42, "licensed under the gnu general public license version 2")]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places})))


def test_base_phrases_agree_with_brute_force(spark):
    got = licenses.scan(table(spark, ROWS, clash=True)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert collected(got) == sorted(((i, *brute(t)) for i, t in ROWS), key=repr)


def test_spans_give_labels(spark):
    of = {r.doc_id: r for r in licenses.scan(table(spark, ROWS)).collect()}
    assert of[30].labels == "cc-by,cc-by-nc" and of[31].labels == "cc-by" and of[31].n_base == 3
    assert of[32].labels == "gpl,gpl-3.0" and of[42].labels == "gpl,gpl-2.0"
    assert of[34].labels == "mit" and of[35].labels == "apache-2.0"
    assert of[36].labels == "mit" and of[36].score == pytest.approx(1)
    assert of[37].labels == "mit" and 0.8 <= of[37].score < 1
    assert of[38].labels == "" and of[39].labels == "" and of[38].score == 0
    assert of[40].labels == "mit" and of[41].labels == ""
    assert all(0 <= r.score <= 1 for r in of.values())


def test_words_keep_what_is_beyond_ascii():
    texts = pa.array(["", "a", "É x日-y_z\x7f9", None, "  A1b  "]).fill_null("")
    flat, offsets = licenses.license_words(texts)
    own = [flat.to_pylist()[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
    assert own == [[], ["a"], ["É", "x日", "y", "z", "9"], [], ["a1b"]]


def test_empty_table(spark):
    assert licenses.scan(table(spark, [])).collect() == []


def test_rows_without_an_id_or_that_share_one_have_their_own_labels(spark):
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0", None, "", prose(3, 40)]
    rows = [(None, t) for t in lines] * 3 + [(7, t) for t in lines] + [(8, lines[0])]
    got = licenses.scan(table(spark, rows)).select("doc_id", "labels", "score").collect()
    labels = ["mit", "apache-2.0", "", "", ""]
    want = [(None, x, float(bool(x))) for x in labels] * 3 + [(7, x, float(bool(x))) for x in labels] + [(8, "mit", 1.0)]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("line,label", [
    ("SPDX-License-Identifier: MIT", "mit"), ("// SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("Licensed under the BSD 3-Clause License", "bsd-3-clause"), ("distributed under the MPL 2.0 license", "mpl-2.0"),
    ("SPDX-License-Identifier: GPL-2.0", "gpl-2.0"), ("licensed under the mitigation license", ""), ("under the mit", "")])
def test_short_forms(spark, line, label):
    rows = [(1, line), (2, f"{prose(4, 30)} {line}\n{prose(5, 30)}")]
    assert {r.labels for r in licenses.scan(table(spark, rows)).collect()} == {label}


def test_method_labels_agree_with_a_search_of_all_windows(spark):
    """Every statement whole or with words put in, left out or changed, against the best window of each text."""
    rng = random.Random(9)
    rows = []
    for i, (_, line) in enumerate(licenses.statements()):
        words = line.split()
        for k in range(3):
            own = list(words)
            for _ in range(k * (len(words) // 15)):
                at = rng.randrange(len(own))
                own[at:at + 1] = rng.choice([[], ["other"], [own[at], "more"]])
            rows.append((3 * i + k, " ".join([prose(i, 12), *own, prose(i + 1, 12)])))
    got = {r.doc_id: (set(r.labels.split(",")) - {""}, r.score) for r in licenses.scan(table(spark, rows)).collect()}
    for i, text in rows:
        words, want, base = text.lower().split(), set(brute(text)[4].split(",")) - {""}, brute(text)[1] > 0
        best = 0.0
        for label, line in licenses.statements():
            template = line.split()
            size = len(template) + 2 * licenses.K
            if len(set(template) & set(words)) < 0.8 * len(set(template)):
                continue
            share = max(licenses.share_in_order(template, words[a:a + size]) for a in range(max(1, len(words) - size + 1)))
            if share >= (1 if len(template) < licenses.SHORT else licenses.LEAST_SHARE):
                want.add(label)
                best = max(best, share)
        assert got[i][0] == want, text
        assert got[i][1] == pytest.approx(1.0 if base else best, abs=0.1)
