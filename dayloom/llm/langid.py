"""Language identification in two steps: the family first, then the languages within it, by linear support vectors.

A text is its byte 1- to 4-grams inside words, hashed into buckets, as shares of all of them. One-versus-one linear
support vector machines separate the families; others, trained on the languages of one family only, separate those. The
family with most votes wins, then of its languages the one with most votes; equal votes go by margins.

Only rows that are not held out, with a language and a letter, teach anything. Each machine learns from a bounded sample:
at most ``TRAINING_TEXTS`` distinct texts of a language, and of a family as many, by hash of the text; machines are
fitted side by side, a group each. Every text is scored whole. Source, lang and doc_id are never inputs of a prediction.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a null doc_id counts as empty text for the
fold; copies of a text count once in the sample; a repeated doc_id gets a row each time; with a single language it is
always predicted with score 1, without any every text is ``und`` with score 0; an empty table gives an empty result; other
columns are not read. The values of lang are taken to be a short list, as codes are: there is a machine for each pair
of families, and of languages of a family.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import counts_per, documents, held_out, mixed, per_slice, slices
from dayloom.session import written

#: Distinct texts that a language, or a family, teaches a machine with at most.
TRAINING_TEXTS = 2_000
#: Buckets of the hashed n-grams.
BUCKETS = 1 << 14
LONGEST = 4
#: Bytes of text that one step works on; its arrays are several times as large.
STEP_BYTES = 1 << 20
UNDETERMINED = "und"
#: Weight of errors against the margin, rounds over the sample, and the share that rare n-grams are damped by.
COST, ROUNDS, DAMPING = 1.0, 30, 1e-5

#: Families by code of the language; fixed values. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nl", "nn", "no", "nb", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "iranian": ("fa", "ku", "ps"),
    "semitic": ("ar", "he", "mt"),
    "austronesian": ("id", "jv", "ms", "tl"),
    "dravidian": ("kn", "ml", "ta", "te"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(lang: str) -> str:
    """Family of a language value such as ``pt`` or ``pt-BR``."""
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"only:{lang}")


#: ASCII that is no letter separates words.
LETTERS = np.array([b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)], np.uint8)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every n-gram; a word begins and ends with a space, which no gram spans."""
    n = len(texts)
    lowered = pa.concat_arrays([pc.utf8_lower(texts)])
    _, offsets, data = lowered.buffers()
    offsets = np.frombuffer(offsets, np.int32 if lowered.type == pa.string() else np.int64)[
        lowered.offset:lowered.offset + n + 1].astype(np.int64)
    raw = LETTERS[np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    # a space before and after each text
    at = np.arange(len(raw)) + np.repeat(2 * np.arange(n) + 1, np.diff(offsets))
    spaced = np.full(len(raw) + 2 * n, 0x20, np.uint8)
    spaced[at] = raw
    owner = np.repeat(np.arange(n), np.diff(offsets) + 2)
    kept = np.ones(len(spaced), bool)
    kept[1:] = (spaced[1:] != 0x20) | (spaced[:-1] != 0x20) | (owner[1:] != owner[:-1])
    spaced, owner = spaced[kept].astype(np.uint64), owner[kept]
    space = spaced == 0x20
    buckets, of = [], []
    code = np.zeros(len(spaced), np.uint64)
    whole = np.ones(len(spaced), bool)  # no space inside and one text
    for size in range(1, LONGEST + 1):
        code = code[:len(spaced) - size + 1] * np.uint64(256) + spaced[size - 1:]
        whole = whole[:len(spaced) - size + 1]
        if size > 2:
            whole = whole & ~space[size - 2:len(spaced) - 1]
        if size > 1:
            whole = whole & (owner[:len(whole)] == owner[size - 1:])
        real = whole & ~(space[:len(whole)] if size == 1 else np.zeros(len(whole), bool))
        if size == 2:
            real = real & ~(space[:len(whole)] & space[1:])
        found = code[real] + (np.uint64(size) << np.uint64(56))
        buckets.append((mixed(found) & np.uint64(BUCKETS - 1)).astype(np.int32))
        of.append(owner[:len(whole)][real])
    return np.concatenate(buckets), np.concatenate(of)


def sampled(docs: DataFrame, most: int) -> DataFrame:
    """lang, turn (a number by hash), buckets and shares of the texts that teach, ``most`` of a language; written.

    Of each language the texts whose hash is below a share are taken, with room for chance, and cut to the ``most``
    lowest; what reaches one task is bounded by that, whatever copies there are.
    """
    rows = documents(docs, "lang").where(
        F.col("lang").isNotNull() & ~held_out("doc_id", 4, 2) & F.col("text").rlike(r"\p{L}")).withColumn(
        "turn", F.xxhash64("text", F.lit(29)))
    found = rows.groupBy("lang").agg(F.approx_count_distinct("turn", 0.02).alias("texts")).collect()
    if not found:
        return rows.limit(0).selectExpr("lang", "turn", "array(0) AS buckets", "array(0D) AS shares")
    room = 1.2 * most + 100
    limits = {r.lang: int(min(1.0, room / max(1, r.texts)) * 2 ** 31) for r in found}
    limit = F.create_map(*(F.lit(v) for pair in limits.items() for v in pair))[F.col("lang")]
    chosen = rows.where(F.pmod("turn", F.lit(2 ** 31)) <= limit).select("lang", "turn", "text")

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        buckets, owner = grams(part.column("text"))
        pairs, counts = np.unique(owner.astype(np.int64) * BUCKETS + buckets, return_counts=True)
        of = pairs // BUCKETS
        total = counts_per(owner, part.num_rows)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts_per(of, part.num_rows))]).astype(np.int32))
        return pa.RecordBatch.from_arrays([
            part.column("lang"), part.column("turn"),
            pa.ListArray.from_arrays(offsets, pa.array((pairs % BUCKETS).astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(counts / np.maximum(total, 1)[of]))], ["lang", "turn", "buckets", "shares"])

    made = chosen.mapInArrow(per_slice(run, limit=STEP_BYTES), "lang string, turn long, buckets array<int>, shares array<double>")
    return written(made.dropDuplicates(["lang", "turn"]), "sample")


@dataclass(frozen=True)
class Pairing:
    """A machine's two sides: a positive margin speaks for ``left``."""

    level: str
    left: str
    right: str


def pairings(langs: list[str]) -> list[Pairing]:
    """One machine for each pair of families, and for each pair of languages of one family."""
    families: dict[str, list[str]] = {}
    for lang in sorted(langs):
        families.setdefault(family_of(lang), []).append(lang)
    names = sorted(families)
    made = [Pairing("family", a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    return made + [Pairing("language", a, b) for f in names for i, a in enumerate(families[f]) for b in families[f][i + 1:]]


def support_vectors(buckets: list[np.ndarray], shares: list[np.ndarray], signs: np.ndarray) -> np.ndarray:
    """Weights of the buckets, and a bias last, by dual coordinate descent on the squared hinge loss.

    A share counts by the root of how common its n-gram is, so that each one's noise weighs alike; both sides weigh alike,
    however many texts they have.
    """
    mean = np.zeros(BUCKETS)
    for b, s in zip(buckets, shares, strict=True):
        mean[b] += s / len(buckets)
    scale = 1.0 / np.sqrt(mean + DAMPING)
    values = [s * scale[b] for b, s in zip(buckets, shares, strict=True)]
    cost = COST * len(signs) / (2 * np.where(signs > 0, max(1, (signs > 0).sum()), max(1, (signs < 0).sum())))
    diagonal = 1 / (2 * cost)
    square = np.array([v @ v for v in values]) + 1.0 + diagonal
    weights, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(signs))
    order = np.random.default_rng(17)
    for _ in range(ROUNDS):
        largest = 0.0
        for i in order.permutation(len(signs)):
            b, v = buckets[i], values[i]
            slope = signs[i] * (weights[b] @ v + bias) - 1 + diagonal[i] * alpha[i]
            step = max(alpha[i] - slope / square[i], 0.0) - alpha[i]
            if step:
                weights[b] += step * signs[i] * v
                bias += step * signs[i]
                alpha[i] += step
                largest = max(largest, abs(step) * square[i])
        if largest < 1e-3:
            break
    return np.append(weights * scale, bias)


def fit(sample: DataFrame, langs: list[str], most: int) -> dict[Pairing, np.ndarray]:
    """All machines, each fitted in a group of its own from at most ``most`` texts a side."""
    wanted = pairings(langs)
    if not wanted:
        return {}
    spark = sample.sparkSession
    in_family: dict[str, int] = {}
    for lang in langs:
        in_family[family_of(lang)] = in_family.get(family_of(lang), 0) + 1
    sides = []
    for k, p in enumerate(wanted):
        for name, sign in ((p.left, 1), (p.right, -1)):
            of = [name] if p.level == "language" else [x for x in langs if family_of(x) == name]
            sides += [(k, x, sign, max(1, most // len(of))) for x in of]
    roles = F.broadcast(spark.createDataFrame(sides, "machine int, lang string, sign int, most int"))
    ranked = sample.groupBy("lang").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    # turns of a bounded sample: some thousands a language
    places = ranked.select("lang", F.posexplode("turns").alias("place", "turn"))
    rows = sample.join(places, ["lang", "turn"]).join(roles, "lang").where("place < most").select(
        "machine", "sign", "turn", "buckets", "shares")

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["turn", "sign"])
        made = support_vectors([np.asarray(b) for b in frame["buckets"]], [np.asarray(s) for s in frame["shares"]],
                               frame["sign"].to_numpy().astype(np.float64))
        return pd.DataFrame({"machine": [frame["machine"].iloc[0]], "weights": [made]})

    found = rows.groupBy("machine").applyInPandas(learn, "machine int, weights array<double>").collect()
    return {wanted[r.machine]: np.array(r.weights) for r in found}


def votes(margins: dict[tuple[str, str], np.ndarray], names: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of the name with most votes, then margin, and how sure its machines are on average."""
    won, sum_of, sure = (np.zeros((len(names), n)) for _ in range(3))
    for (a, b), margin in margins.items():
        i, j = names.index(a), names.index(b)
        chance = 1 / (1 + np.exp(-np.clip(2 * margin, -50, 50)))
        won[i], won[j] = won[i] + (margin > 0), won[j] + (margin <= 0)
        sum_of[i], sum_of[j] = sum_of[i] + margin, sum_of[j] - margin
        sure[i], sure[j] = sure[i] + chance, sure[j] + 1 - chance
    best = np.argmax(won + 0.4 * np.tanh(sum_of) if len(names) > 1 else won, axis=0)
    return best, sure[best, np.arange(n)] / (len(names) - 1) if len(names) > 1 else np.ones(n)


def predicted(texts: pa.Array, langs: list[str], machines: dict[Pairing, np.ndarray]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    n = len(texts)
    letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False).astype(bool)
    if not langs:
        return [UNDETERMINED] * n, np.zeros(n)
    buckets, owner = grams(texts)
    total = np.maximum(counts_per(owner, n), 1)
    margins = {p: counts_of(owner, n, w[buckets]) / total + w[-1] for p, w in machines.items()}
    families: dict[str, list[str]] = {}
    for lang in sorted(langs):
        families.setdefault(family_of(lang), []).append(lang)
    names = sorted(families)
    best, score = votes({(p.left, p.right): m for p, m in margins.items() if p.level == "family"}, names, n)
    chosen = np.full(n, UNDETERMINED, object)
    for k, family in enumerate(names):
        own = families[family]
        inside, sure = votes({(p.left, p.right): m for p, m in margins.items() if p.level == "language" and p.left in own},
                             own, n)
        here = best == k
        chosen[here] = np.array(own, object)[inside[here]]
        score = np.where(here, score * sure, score)
    chosen[~letters] = UNDETERMINED
    return chosen.tolist(), np.where(letters, np.clip(score, 0, 1), 0.0)


def counts_of(owner: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    return np.bincount(owner, weights=weights, minlength=n)


def languages(docs: DataFrame, most: int = TRAINING_TEXTS) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    sample = sampled(docs, most)
    langs = sorted(r.lang for r in sample.select("lang").distinct().collect())
    machines = fit(sample, langs, most)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=STEP_BYTES):
                found, score = predicted(part.column("text"), langs, machines)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(found, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"])
            del batch
            pa.default_memory_pool().release_unused()

    rows = documents(docs).withColumn("held_out", held_out("doc_id", 4, 2))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
