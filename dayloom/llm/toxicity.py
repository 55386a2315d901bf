"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are densities: of lexicon words and stems, of lexicon words near a second-person word, of capitals,
punctuation, obfuscated spellings, and lengths. The lexicons are a short fixed list and what the labels teach: words
and word beginnings far commoner in toxic texts. Trees and calibration are Spark MLlib's, fitted on different rows.

Only rows that are not held out teach anything. Labels, lang, source and doc_id are never inputs.

Defined cases: a null or empty text has all features 0 and gets the score of such a row; a null doc_id counts as
empty text for the fold and has no label; a repeated doc_id gets a label per row; without both classes among the
training rows every score is their rate of toxic rows (0 without any); an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import counts_per, documents, held_out, owners, per_slice, small_batches, translated, words
from dayloom.operators.sizes import broadcast_if_small
from dayloom.session import written

#: Labelled rows, by hash of id and text, that the trees and the calibration learn from; the lexicon counts all of its part.
TRAINING_ROWS = 60_000
#: Bytes of text that one step makes features of; its arrays are several times as large.
STEP_BYTES = 2 << 20
#: Documents that a worker is handed at once, where the stage is run here.
BATCH_ROWS = 1_000
#: How sure an entry of the learned lexicon must be: its log-likelihood ratio, beyond twice the logarithm of the number of
#: terms that were looked at. Chance makes none however many terms there are, so the lexicon needs no cap.
LEAST_EVIDENCE = 8.0
#: Tenths of the labelled texts that teach the lexicon.
LEXICON_PART = 4
THRESHOLD = 0.3

#: Insults and slurs that need no label; fixed values.
INSULTS = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "pathetic", "worthless", "disgusting",
    "trash", "scum", "clown", "garbage", "filth", "filthy", "ugly", "hate", "kill", "die", "shut", "fool", "jerk",
    "idiote", "imbécile", "connard", "salaud", "ordure", "débile", "dumm", "dummkopf", "arschloch", "abschaum",
    "trottel", "idiota", "imbécil", "estúpido", "basura", "asqueroso",
)
SECOND_PERSON = ("you", "your", "you're", "yours", "u", "ur", "tu", "toi", "te", "vous", "du", "dich", "dir", "ihr",
                 "tú", "ti", "usted", "vosotros")
STEM_LENGTHS = (4, 5, 6)
NEAR = 5
FEATURES = ("insults", "insult_rate", "learned", "learned_rate", "stems", "stem_rate", "near_person", "person_rate",
            "capitals", "capital_words", "punctuation", "marks", "obfuscated", "word_length", "log_words",
            "distinct_rate")
#: Lower-cased A-Z, and a space for ASCII punctuation that stands at word ends; leet signs stay.
PLAIN = bytes(0x20 if chr(b) in ".,;:!?()[]{}\"|<>*#%&=+/\\_~^`-" else b for b in bytes(range(256)).lower())
#: Digits and signs that stand for letters in obfuscated spellings; fixed values.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    flat, offsets = words(translated(texts, PLAIN))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets, coded.dictionary


def stems_of(vocabulary: pa.Array, length: int) -> pa.Array:
    """The beginnings of the words that are longer; others null."""
    cut = pc.utf8_slice_codeunits(vocabulary, 0, length)
    return pc.if_else(pc.greater(pc.utf8_length(vocabulary), length), cut, pa.scalar(None, pa.string()))


def term_counts(rows: DataFrame) -> DataFrame:
    """kind (0: word, else stem length), term, texts with it, toxic texts with it; added up in each task first.

    Kind -1 is all texts.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        codes, offsets, vocabulary = plain_words(part.column("text"))
        owner, toxic = owners(offsets), part.column("toxic").to_numpy(zero_copy_only=False) == 1
        columns = [[pa.array([-1], pa.int32())], [pa.array([""])], [pa.array([len(toxic)])], [pa.array([int(toxic.sum())])]]
        for kind in (0, *STEM_LENGTHS):
            terms = (stems_of(vocabulary, kind) if kind else vocabulary).dictionary_encode()
            number = pc.fill_null(terms.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
            kept = number >= 0
            n = max(1, len(terms.dictionary))
            pair = np.unique(owner[kept] * n + number[kept])
            texts, bad = counts_per(pair % n, n), counts_per(pair % n, n, toxic[pair // n])
            some = np.flatnonzero(texts)
            for column, values in zip(columns, (pa.array(np.full(len(some), kind, np.int32)),
                                                terms.dictionary.take(pa.array(some)), pa.array(texts[some]),
                                                pa.array(bad[some])), strict=True):
                column.append(values)
        return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], ["kind", "term", "texts", "toxic"])

    counted = rows.mapInArrow(per_slice(run, limit=STEP_BYTES), "kind int, term string, texts long, toxic long")
    return counted.groupBy("kind", "term").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))


def learned_lexicon(rows: DataFrame) -> dict[int, list[str]]:
    """Words (0) and stems (their length) at least ten times as likely in toxic texts as in others."""
    terms = written(term_counts(rows).where("kind = -1 or toxic >= 5"), "terms")
    total, bad = terms.where("kind = -1").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("texts", "toxic"))).first()
    if not bad or bad == total:
        return {kind: [] for kind in (0, *STEM_LENGTHS)}
    odds = ((F.col("toxic") + F.lit(0.5)) / F.lit(float(bad))) / (
        (F.col("texts") - F.col("toxic") + F.lit(0.5)) / F.lit(float(total - bad)))
    evidence = log_likelihood(F.col("texts"), F.col("toxic"), total, bad)
    bound = LEAST_EVIDENCE + 2 * math.log(max(1, terms.count()))
    found: dict[int, list[str]] = {kind: [] for kind in (0, *STEM_LENGTHS)}
    for row in terms.where((F.col("kind") >= 0) & (odds >= 10) & (evidence >= bound)).select("kind", "term").orderBy("kind", "term").collect():
        found[row.kind].append(row.term)
    return found


def log_likelihood(texts: Column, toxic: Column, total: int, bad: int) -> Column:
    """Dunning's ratio: how much better two rates of toxic texts, with the term and without, explain the counts than one."""
    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    rate, rest = F.lit(bad / total), F.lit(1 - bad / total)
    without, clean = F.lit(total) - texts, F.lit(bad) - toxic
    return 2 * (part(toxic, texts * rate) + part(texts - toxic, texts * rest)
                + part(clean, without * rate) + part(without - clean, without * rest))


def features(texts: pa.Array, lexicon: dict[int, list[str]]) -> np.ndarray:
    """One row of FEATURES per text."""
    n = len(texts)
    codes, offsets, vocabulary = plain_words(texts)
    owner, n_words = owners(offsets), np.diff(offsets)
    per = np.maximum(n_words, 1)

    def among(values: pa.Array, terms) -> np.ndarray:
        return pc.is_in(values, pa.array(list(terms), pa.string())).to_numpy(zero_copy_only=False).astype(bool)

    def total(of_vocabulary: np.ndarray) -> np.ndarray:
        return counts_per(owner, n, of_vocabulary.astype(np.float64)[codes])

    insult, learned = among(vocabulary, INSULTS), among(vocabulary, lexicon[0])
    stem = np.zeros(len(vocabulary), bool)
    for length in STEM_LENGTHS:
        stem |= among(stems_of(vocabulary, length), lexicon[length])
    odd = np.flatnonzero(pc.match_substring_regex(vocabulary, r"[\p{L}][0-9@$!]+[\p{L}]").to_numpy(zero_copy_only=False))
    hidden = np.zeros(len(vocabulary), bool)
    bad_words = {*INSULTS, *lexicon[0]}
    for i in odd:
        hidden[i] = vocabulary[int(i)].as_py().translate(LEET) in bad_words
    person = np.flatnonzero(among(vocabulary, SECOND_PERSON)[codes])
    bad = np.flatnonzero((insult | learned | stem | hidden)[codes])
    near = np.zeros(n, np.int64)
    if len(person) and len(bad):
        after = np.searchsorted(person, bad)
        gaps = []
        for at in (np.clip(after - 1, 0, len(person) - 1), np.clip(after, 0, len(person) - 1)):
            gaps.append(np.where(owner[person[at]] == owner[bad], np.abs(person[at] - bad), NEAR + 1))
        near = counts_per(owner[bad], n, np.minimum(*gaps) <= NEAR)
    chars = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1)
    count = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
    shouted = count(r"\b[A-Z]{3,}\b")
    distinct = counts_per(np.unique(owner * max(1, len(vocabulary)) + codes) // max(1, len(vocabulary)), n)
    return np.column_stack([
        total(insult), total(insult) / per, total(learned), total(learned) / per, total(stem), total(stem) / per,
        near, counts_per(owner[person], n) / per, count("[A-Z]") / chars, shouted / per, count(r"[!?.,;:]") / chars,
        count(r"[!?]") / chars, (total(hidden) + count(r"\b[a-zA-Z]+[*@$]+[a-zA-Z]+\b")) / per,
        total(pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False)) / per, np.log1p(n_words), distinct / per,
    ]).astype(np.float64)


def with_features(rows: DataFrame, lexicon: dict[int, list[str]], *more: str) -> DataFrame:
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        made = features(part.column("text"), lexicon)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), *(part.column(m) for m in more), *(pa.array(c) for c in made.T)],
            ["doc_id", *more, *FEATURES])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("doc_id", "text", *more).mapInArrow(per_slice(run, limit=STEP_BYTES), ", ".join(
        [*(f"{c} {kinds[c]}" for c in ("doc_id", *more)), *(f"{f} double" for f in FEATURES)]))


def text_part() -> Column:
    """0 to 9 by text, so that copies stay together: below LEXICON_PART the lexicon learns, from there the trees and the
    calibration, each from different rows, or a word seen once would look like proof."""
    return F.pmod(F.xxhash64("text", F.lit(5)), F.lit(10))


def teaching(labels: DataFrame) -> DataFrame:
    """label_id and toxic of the labels that are not held out."""
    marks = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "label_id is not null and toxic in (0, 1)")
    return marks.where(~held_out("label_id", 4, 2))


def with_labels(docs: DataFrame, marks: DataFrame) -> DataFrame:
    return docs.join(broadcast_if_small(marks), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic")


def labelled(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """text and toxic of the labelled rows that are not held out, at most about ``most`` by hash of id and text; written.

    Copies of a text are drawn one by one, so that a group of them is in the sample as often as among the labels.
    """
    marks, rows = teaching(labels), documents(docs)
    share = min(1.0, most / max(1, marks.count()))
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1_000_000)) < int(share * 1_000_000))
    return written(with_labels(rows, marks), "labelled")


def scores(docs: DataFrame, labels: DataFrame, *more: str, most: int = TRAINING_ROWS) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, and what else is named of the documents' columns."""
    rows = labelled(docs, labels, most)
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    fold = held_out("doc_id", 4, 2)
    if not counted.bad or counted.bad == counted.n:
        rate = float(counted.bad) / counted.n if counted.n else 0.0
        return docs.select("doc_id", *more, fold.alias("held_out"), F.lit(rate).alias("score"),
                           F.lit(int(rate >= THRESHOLD)).alias("predicted"))
    part = text_part()
    lexicon = learned_lexicon(with_labels(documents(docs).where(part < LEXICON_PART), teaching(labels)))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    taught = written(with_features(rows.withColumn("part", part), lexicon, "part", "toxic"), "features")
    taught = assembler.transform(taught.repartition(6))
    fitting, rest = taught.where((F.col("part") >= LEXICON_PART) & (F.col("part") < 8)), taught.where("part >= 8")
    two = lambda df: df.agg(F.count_distinct("toxic")).first()[0] == 2
    fitting, rest = (fitting, rest) if two(fitting) and two(rest) else (taught, taught)
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=30, maxDepth=4, stepSize=0.2, maxBins=64,
                          seed=17, checkpointInterval=-1).fit(fitting)
    raw = vector_to_array("probability")[1]
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="label", isotonic=True).fit(
        trees.transform(rest).select(raw.alias("raw"), F.col("toxic").cast("double").alias("label")))
    scored = trees.transform(assembler.transform(with_features(documents(docs, *more), lexicon, *more))).select(
        "doc_id", *more, raw.alias("raw"))
    calibrated = isotonic.transform(scored)
    # a step of the calibration keeps the order of the trees inside it
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.98 * F.col("prediction") + 0.02 * F.col("raw")))
    return calibrated.select("doc_id", *more, fold.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def kept_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are not predicted toxic; of rows that share a doc_id each by its text."""
    with small_batches(docs.sparkSession, BATCH_ROWS):
        found = scores(documents(docs).withColumn("text_sha256", F.sha2("text", 256)), labels, "text_sha256")
        toxic = written(found.where("predicted = 1").select(
            F.col("doc_id").alias("toxic_id"), F.col("text_sha256").alias("toxic_sha")).distinct(), "toxic")
    text_sha = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    return docs.join(broadcast_if_small(toxic), docs["doc_id"].eqNullSafe(toxic["toxic_id"]) & (text_sha == toxic["toxic_sha"]),
                     "left_anti")
