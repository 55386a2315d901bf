"""License scans by diagonal voting.

The hash of every run of K words of every text is joined with the places where the templates have it. A match votes
for its diagonal (place in the text less place in the template); diagonals of one template that lie close together
are one candidate span, which is verified word by word against the template in the text itself.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased: digits, letters, all beyond ASCII.

Votes and spans are kept by doc_id and text, so that rows without a doc_id, or that share one, have their own.

Defined cases: a null or empty text has no words, no label and score 0; rows without doc_id, and rows that repeat one, each
get the spans of their own text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayloom.llm.common import documents, hashes, owners, per_slice, translated, window_hashes, words
from dayloom.operators.sizes import broadcast_if_small
from dayloom.session import written

K = 3
#: Diagonals of one template so close together are one candidate: words put in or left out.
NEIGHBOURS = 3
#: Share of a template's words that a span must hold in order; of a template under SHORT words, all.
LEAST_SHARE, SHORT = 0.8, 12
#: A-Z lower-cased, and a space for each ASCII byte that is neither a digit nor a letter.
WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())

#: Base phrases and their labels; fixed values.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Well-known license statements, as words.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0",
    ),
    "mit": (
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the software",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the distribution",
    ),
    "bsd-3-clause": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "cc0-1.0": ("to the extent possible under law the author has waived all copyright and related or neighboring rights",),
    "agpl-3.0": (
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
        "the free software foundation",
    ),
    "lgpl": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation",
    ),
    "epl-2.0": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",),
    "cc-by-nc": ("licensed under cc by nc 4 0", "creative commons attribution noncommercial 4 0 international"),
    "cc-by-sa": ("licensed under cc by sa 4 0", "creative commons attribution sharealike 4 0 international"),
    "gpl-3.0": (
        "licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ),
    "gpl-2.0": ("licensed under the gnu general public license version 2",),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
}


#: Names as short statements write them, in words; each makes the statements of SHORT_FORMS.
NAMES: dict[str, tuple[str, ...]] = {
    "agpl-3.0": ("agpl 3 0",),
    "apache-2.0": ("apache 2 0",),
    "bsd-2-clause": ("bsd 2 clause",),
    "bsd-3-clause": ("bsd 3 clause",),
    "cc0-1.0": ("cc0 1 0",),
    "epl-2.0": ("epl 2 0",),
    "gpl-2.0": ("gpl 2 0", "gpl v2"),
    "gpl-3.0": ("gpl 3 0", "gpl v3"),
    "isc": ("isc",),
    "lgpl": ("lgpl 2 1", "lgpl 3 0"),
    "mit": ("mit",),
    "mpl-2.0": ("mpl 2 0",),
    "unlicense": ("unlicense",),
}
SHORT_FORMS = ("spdx license identifier {}", "licensed under the {} license", "released under the {} license",
               "distributed under the {} license")


def license_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in a row, and where each text's begin."""
    return words(translated(texts, WORD_BYTES))


def template_grams(spark: SparkSession) -> DataFrame:
    """gram, template (a number), place: some hundreds of rows, whatever the documents."""
    rows = []
    for number, (_, line) in enumerate(statements()):
        grams = window_hashes(hashes(pa.array(line.split())), K).view(np.int64)
        rows += [(int(gram), number, place) for place, gram in enumerate(grams)]
    return spark.createDataFrame(rows, "gram long, template int, place int")


def statements() -> list[tuple[str, str]]:
    """label and line of every template; each line once."""
    short = [(label, form.format(name)) for label, names in NAMES.items() for name in names for form in SHORT_FORMS]
    return list(dict.fromkeys([*((label, line) for label, lines in TEMPLATES.items() for line in lines), *short]))


def text_mark():
    return F.xxhash64("text")


def grams(docs: DataFrame) -> DataFrame:
    """doc_id, mark of the text, start, gram: all rolling K-word hashes of every whole text."""
    frame = documents(docs).withColumn("mark", text_mark())

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = license_words(part.column("text"))
        coded = flat.dictionary_encode()
        hashed = hashes(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        owner = owners(offsets)
        gram = window_hashes(hashed, K)
        inside = np.flatnonzero(np.arange(len(gram)) + K <= offsets[1:][owner[:len(gram)]])
        owner = owner[inside]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(pa.array(owner)), part.column("mark").take(pa.array(owner)),
             pa.array(inside - offsets[owner], pa.int64()), pa.array(gram[inside].view(np.int64))], ["doc_id", "mark", "start", "gram"])

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(per_slice(run), f"doc_id {kind}, mark long, start long, gram long")


def candidates(docs: DataFrame) -> DataFrame:
    """Spans by diagonal votes: doc_id, mark, template, first and last start of a matching run of words, votes.

    The join is with the templates' few runs of words, sent to every task; only matches are shuffled, counted by
    diagonal before that.
    """
    votes = grams(docs).join(F.broadcast(template_grams(docs.sparkSession)), "gram").groupBy(
        "doc_id", "mark", "template", (F.col("start") - F.col("place")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.min("start").alias("low"), F.max("start").alias("high"))
    order = Window.partitionBy("doc_id", "mark", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) <= NEIGHBOURS)
    numbered = votes.withColumn("new", F.when(apart, 0).otherwise(1)).withColumn("cluster", F.sum("new").over(order))
    return numbered.groupBy("doc_id", "mark", "template", "cluster").agg(
        F.sum("votes").alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"))


def least_votes(template: list[str]) -> int:
    """Runs of K words that a candidate must share: a third, of a short template more than half."""
    runs = len(template) - K + 1
    return max(1, runs // 3) if len(template) >= SHORT else max(1, -(-runs * 3 // 5))


def share_in_order(template: list[str], words: list[str]) -> float:
    """Words of the template that the span holds in the template's order, as a share."""
    blocks = SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks()
    return sum(b.size for b in blocks) / len(template)


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans.

    ``score`` is the largest share of a template that a span holds, and 1 where a base phrase stands.
    """
    frame = documents(docs).withColumn("mark", text_mark())
    least = F.create_map(*(F.lit(x) for i, (_, line) in enumerate(statements())
                           for x in (i, least_votes(line.split()))))
    spans = candidates(docs).where(F.col("votes") >= least[F.col("template")]).groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("template", "low", "high")).alias("spans"))
    spans = written(spans.withColumnsRenamed({"doc_id": "span_id", "mark": "span_mark"}), "spans")
    same = F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.col("mark") == F.col("span_mark"))
    joined = frame.join(broadcast_if_small(spans), same, "left").select(
        "doc_id", "text", "spans")
    lines = [(label, line.split()) for label, line in statements()]
    phrases = [(label, hashes(pa.array(phrase.split()))) for phrase, label in PHRASES.items()]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_spans"]

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = license_words(part.column("text"))
        coded = flat.dictionary_encode()
        hashed = hashes(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        owner, n = owners(offsets), part.num_rows
        found, first, last = np.zeros(n, np.int64), [None] * n, [None] * n
        base: list[set[str]] = [set() for _ in range(n)]
        for label, phrase in phrases:
            size = len(phrase)
            hit = np.ones(max(0, len(hashed) - size + 1), bool)
            for i in range(size):
                hit &= hashed[i:i + len(hit)] == phrase[i]
            at = np.flatnonzero(hit)
            at = at[at + size <= offsets[1:][owner[at]]]
            for row, place in zip(owner[at].tolist(), (at - offsets[owner[at]]).tolist(), strict=True):
                found[row] += 1
                base[row].add(label)
                first[row] = place if first[row] is None else min(first[row], place)
                last[row] = place if last[row] is None else max(last[row], place)
        score = [1.0 if b else 0.0 for b in base]
        labels, n_spans = [set(b) for b in base], np.zeros(n, np.int64)
        for row, own in enumerate(part.column("spans").to_pylist()):
            for span in own or ():
                label, template = lines[span["template"]]
                size = offsets[row + 1] - offsets[row]
                low, high = max(0, span["low"] - K), min(size, span["high"] + 2 * K)
                own_words = flat.slice(offsets[row] + low, max(0, high - low)).to_pylist()
                share = best_share(template, own_words)
                if share >= (1 if len(template) < SHORT else LEAST_SHARE):
                    n_spans[row] += 1
                    labels[row].add(label)
                    score[row] = max(score[row], share)
        joined_names = lambda sets: pa.array([",".join(sorted(s)) for s in sets], pa.string())
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(found), pa.array(first, pa.int64()),
             pa.array(last, pa.int64()), joined_names(base), joined_names(labels), pa.array(score, pa.float64()),
             pa.array(n_spans)], names)

    kind = frame.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(per_slice(run), f"doc_id {kind}, n_words long, n_base long, first_word long, "
                             "last_word long, base_labels string, labels string, score double, n_spans long")


def best_share(template: list[str], words: list[str]) -> float:
    """The best share over the span; a long span (statements that follow one another) is gone through in steps."""
    size = len(template) + 2 * K + NEIGHBOURS
    if len(words) <= 2 * size:
        return share_in_order(template, words)
    return max(share_in_order(template, words[i:i + 2 * size]) for i in range(0, len(words), size))
