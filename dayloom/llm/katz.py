"""Katz backoff language model: counted, discounted, normalised and evaluated as Spark jobs over packed arrays.

Texts are encoded once into shards: word numbers of some megabytes of text. Shards and model meet by buckets of sorted
numbers, never row by row: a shard sends the distinct words or pairs that it has, with counts, to the buckets they
belong to; a bucket adds them up, and answers each shard in the order of its question.

* Words are numbered by falling count, so a word's count follows from its number and the short list of distinct
  counts (at most about the square root of twice the tokens), and pairs of numbers compress well.
* Pairs (context, word) go to the bucket of their context. The HOT commonest words (``most``) are spread over all buckets by the
  pair; what their contexts sum to is added up afterwards, HOT rows at most.
* A pair seen r times counts as r * d(r), d by Good-Turing from the numbers of pairs seen r and r + 1 times, up to
  KATZ times. What a context's pairs leave goes to the unseen words in proportion to their base probability, with
  the weight that makes the context's probabilities add up to 1. A context that would leave nothing keeps
  1 / (2 c + 2) back.

P(w | h) = s(h) d(r) r / c(h) for a pair seen r > 0 times, else alpha(h) P(w); P(w) = (c + 0.1) / (N + 0.1 (V + 1)).
A context never seen has alpha 1. A text begins in the context BEGIN and ends with the token END.

With ``order`` 3 the same is done once more: P(w | g h) = s(g h) d(r) r / c(g h) for a triple seen, else alpha(g h) P(w | h).
A shard settles the triples of pairs that stand in its own training texts alone, and asks for the others. What it is
told of a pair are sums that make the pair's weights once all triples have been counted. The HOT commonest pairs are
spread as the words are.

Defined cases: a null or empty text is the token END alone; rows that repeat a doc_id count and are scored each; a null
doc_id counts as an empty text when rows are held out; without training rows every probability is the base one of a
single unknown word, 1; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayloom.llm.common import documents, hashes, held_out, mixed, slices, tidy, word_codes
from dayloom.session import fresh_folder, remove_folder, written

KATZ = 5
HOT = 4096
#: Words of the longest n-grams that the registered query counts.
ORDER = 2
SHARD_BYTES = 8 << 20
#: Distinct words, or pairs, of one bucket, about.
BUCKET_ITEMS = 1_000_000
END_HASH = xxhash.xxh3_64_intdigest(b" end ")
BEGIN, UNKNOWN = 0, (1 << 32) - 1
ADDED = 0.1


def pack(values: np.ndarray) -> bytes:
    """Rising or small whole numbers, compressed: differences by byte planes."""
    steps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1) if len(values) else b""


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def pack_plain(values: np.ndarray) -> bytes:
    """Numbers in any order, by byte planes; the type is the reader's to know."""
    values = np.ascontiguousarray(values)
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), 1) if len(values) else b""


def unpack_plain(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


def bucket_of(hashed: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(hashed.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places of its items, in their order."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for start, stop in zip(edges, [*edges[1:], len(order)], strict=True):
        yield int(bucket[order[start]]), order[start:stop]


def shards(docs: DataFrame, out) -> DataFrame:
    """shard, doc_ids, held, starts, codes, vocabulary: texts as numbers of their shard's words, in order of hash.

    ``codes`` has one END after each text. ``held`` marks the rows that teach nothing.
    """
    frame = documents(docs).withColumn("held", out)
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in enumerate(p for batch in batches for p in slices(batch, limit=SHARD_BYTES)):
            codes, offsets, vocabulary = word_codes(pc.ascii_lower(part.column("text")))
            hashed = np.append(hashes(vocabulary), np.uint64(END_HASH))
            codes = np.insert(codes, offsets[1:], len(vocabulary))
            distinct, place = np.unique(hashed, return_inverse=True)
            codes = place[codes].astype(np.int32)
            ids = part.column("doc_id")
            held = part.column("held").to_numpy(zero_copy_only=False).astype(np.uint8)
            starts = offsets + np.arange(len(offsets))
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() << 32 | number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 *(pa.array([b], pa.binary()) for b in (held.tobytes(), pack(starts), pack_plain(codes), pack_plain(distinct)))],
                ["shard", "doc_ids", "held", "starts", "codes", "vocabulary"])

    return frame.mapInArrow(run, f"shard long, doc_ids array<{kind}>, held binary, starts binary, codes binary, vocabulary binary")


def taught(held: bytes, starts: np.ndarray) -> np.ndarray:
    """Whether each token is of a text that teaches."""
    return np.repeat(np.frombuffer(held, np.uint8) == 0, np.diff(starts))


def word_questions(parts: DataFrame, buckets: int) -> DataFrame:
    """bucket, shard, words (distinct, by hash), counts among training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                starts, codes = unpack(row["starts"]), unpack_plain(row["codes"], np.int32)
                distinct = unpack_plain(row["vocabulary"], np.uint64)
                counts = np.bincount(codes, weights=taught(row["held"], starts), minlength=len(distinct)).astype(np.int64)
                made = [(b, row["shard"], pack_plain(distinct[at]), pack_plain(counts[at].astype(np.uint32)))
                        for b, at in by_bucket(bucket_of(distinct, buckets))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*made, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                    ["bucket", "shard", "words", "counts"])

    return parts.select("shard", "held", "starts", "codes", "vocabulary").mapInArrow(
        run, "bucket int, shard long, words binary, counts binary")


def add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and their summed counts."""
    distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(number, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)


def word_table(questions: DataFrame) -> DataFrame:
    """bucket, words (sorted hashes), counts: the words that training texts have."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        words, counts = add_up([unpack_plain(w, np.uint64) for w in frame["words"]],
                               [unpack_plain(c, np.uint32).astype(np.int64) for c in frame["counts"]])
        known = counts > 0
        return pd.DataFrame({"bucket": [frame["bucket"].iloc[0]], "words": [pack_plain(words[known])],
                             "counts": [pack_plain(counts[known])]})

    return questions.groupBy("bucket").applyInPandas(run, "bucket int, words binary, counts binary")


def counts_of_counts(table: DataFrame, *keep: str) -> DataFrame:
    """``count`` and the number of items that have it (``n``), by the kept columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for i in range(len(frame)):
                value, n = np.unique(unpack_plain(frame["counts"].iloc[i], np.int64), return_counts=True)
                yield pd.DataFrame({k: frame[k].iloc[i] for k in keep} | {"count": value, "n": n})

    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    made = table.select(*keep, "counts").mapInPandas(run, ", ".join([*(f"{k} {kinds[k]}" for k in keep), "count long, n long"]))
    return made.groupBy(*keep, "count").agg(F.sum("n").alias("n"))


class Levels:
    """Counts of numbered words: number 1 on belongs to the highest count, and so forth down."""

    def __init__(self, counted: list[tuple[int, int]]):
        counted = sorted(counted, reverse=True)
        self.counts = np.array([c for c, _ in counted] + [0], np.int64)
        self.ends = np.cumsum(np.array([n for _, n in counted], np.int64)) + 1  # first number beyond each level
        self.words = int(sum(n for _, n in counted))
        self.tokens = int(sum(c * n for c, n in counted))

    def count(self, numbers: np.ndarray) -> np.ndarray:
        """Count of each word; 0 for UNKNOWN."""
        return self.counts[np.searchsorted(self.ends, numbers, side="right")]

    def base(self, numbers: np.ndarray) -> np.ndarray:
        return (self.count(numbers) + ADDED) / (self.tokens + ADDED * (self.words + 1))


def numbered(questions: DataFrame, table: DataFrame, levels: Levels) -> DataFrame:
    """bucket, shard, numbers: what each shard asked for, in its order; UNKNOWN where no training text has the word."""
    # words of the same count are numbered bucket by bucket, from where the buckets before have come
    before = Window.partitionBy("count").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts_of_counts(table, "bucket").withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    offsets = first.groupBy("bucket").agg(F.collect_list(F.struct("count", "before")).alias("offsets"))
    starts = np.concatenate([[1], levels.ends])[:-1] if len(levels.ends) else np.zeros(0, np.int64)
    start_of = dict(zip(levels.counts[:-1].tolist(), starts.tolist(), strict=True))

    def run(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        words, numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(held):
            words = unpack_plain(held["words"].iloc[0], np.uint64)
            counts = unpack_plain(held["counts"].iloc[0], np.int64)
            numbers = np.zeros(len(words), np.int64)
            before_of = {o["count"]: o["before"] for o in (held["offsets"].iloc[0] if held["offsets"].iloc[0] is not None else ())}
            for count, at in by_bucket(counts):
                numbers[at] = start_of[count] + before_of[count] + np.arange(len(at))
        answers = []
        for asked_words in asked["words"]:
            own = unpack_plain(asked_words, np.uint64)
            at = np.minimum(np.searchsorted(words, own), max(0, len(words) - 1))
            found = words[at] == own if len(words) else np.zeros(len(own), bool)
            answers.append(pack_plain(np.where(found, numbers[at] if len(words) else 0, UNKNOWN).astype(np.uint32)))
        return pd.DataFrame({"bucket": asked["bucket"], "shard": asked["shard"], "numbers": answers})

    return questions.select("bucket", "shard", "words").groupBy("bucket").cogroup(
        table.join(offsets, "bucket", "left").groupBy("bucket")).applyInPandas(run, "bucket int, shard long, numbers binary")


def in_numbers(parts: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """The shards with ``vocabulary`` replaced by ``numbers``, the global number of each of their words."""
    collected = answers.groupBy("shard").agg(F.collect_list(F.struct("bucket", "numbers")).alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for i in range(batch.num_rows):
                distinct = unpack_plain(batch.column("vocabulary")[i].as_py(), np.uint64)
                numbers = np.full(len(distinct), UNKNOWN, np.uint32)
                own = {a["bucket"]: a["numbers"] for a in batch.column("answers")[i].as_py() or ()}
                for b, at in by_bucket(bucket_of(distinct, buckets)):
                    numbers[at] = unpack_plain(own[b], np.uint32)
                made.append(pack_plain(numbers))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("shard", "doc_ids", "held", "starts", "codes")), pa.array(made, pa.binary())],
                ["shard", "doc_ids", "held", "starts", "codes", "numbers"])

    kinds = {f.name: f.dataType.simpleString() for f in parts.schema}
    return parts.join(collected, "shard").mapInArrow(run, f"shard long, doc_ids {kinds['doc_ids']}, held binary, starts binary, "
                                                     "codes binary, numbers binary")


def pairs_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a shard's tokens: the pair with the one before (context << 32 | word), whether it teaches, starts, words."""
    starts, codes = unpack(row["starts"]), unpack_plain(row["codes"], np.int32)
    word = unpack_plain(row["numbers"], np.uint32)[codes].astype(np.uint64)
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[starts[:-1]] = BEGIN
    return context << np.uint64(32) | word, taught(row["held"], starts), starts, word


def pair_bucket(pairs: np.ndarray, buckets: int, most: int) -> np.ndarray:
    """By context; pairs of BEGIN and the ``most`` commonest contexts by the whole pair."""
    context = pairs >> np.uint64(32)
    return bucket_of(np.where(context <= most, mixed(pairs) ^ np.uint64(5), context), buckets)


def pair_questions(parts: DataFrame, buckets: int, most: int) -> DataFrame:
    """bucket, shard, pairs (distinct, sorted, of known contexts), counts among training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, teaches, _, _ = pairs_of(row)
                known = pairs >> np.uint64(32) != UNKNOWN
                distinct, number = np.unique(pairs[known], return_inverse=True)
                counts = np.bincount(number, weights=teaches[known], minlength=len(distinct)).astype(np.uint32)
                made = [(b, row["shard"], pack(distinct[at].view(np.int64)), pack_plain(counts[at]))
                        for b, at in by_bucket(pair_bucket(distinct, buckets, most))]
                if made:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*made, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                        ["bucket", "shard", "pairs", "counts"])

    return parts.select("shard", "held", "starts", "codes", "numbers").mapInArrow(
        run, "bucket int, shard long, pairs binary, counts binary")


def pair_table(questions: DataFrame) -> DataFrame:
    """Both what training texts have and what each shard is told, by one shuffle.

    kind 'model': bucket, pairs (sorted), counts. kind 'answer': bucket, shard, seen (the count of each asked pair),
    contexts (the distinct ones asked, sorted).
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        asked = [unpack(p) for p in frame["pairs"]]
        pairs, counts = add_up(asked, [unpack_plain(c, np.uint32).astype(np.int64) for c in frame["counts"]])
        seen = [pack_plain(counts[np.searchsorted(pairs, own)]) for own in asked]
        known, n = counts > 0, len(asked)
        return pd.DataFrame({
            "bucket": frame["bucket"].iloc[0], "shard": [*frame["shard"], 0], "pairs": [None] * n + [pack(pairs[known])],
            "counts": [None] * n + [pack_plain(counts[known])], "seen": [*seen, None],
            "contexts": [*(pack(np.unique(own >> 32)) for own in asked), None], "kind": ["answer"] * n + ["model"]})

    return questions.groupBy("bucket").applyInPandas(
        run, "bucket int, shard long, pairs binary, counts binary, seen binary, contexts binary, kind string")


def discounts(n: dict[int, int]) -> np.ndarray:
    """d(0..KATZ + 1) by Good-Turing and Katz; d(r) is 1 beyond KATZ.

    Where the numbers of pairs seen r times don't fall as they should, d(r) is 1 - 1/(2 r + 2), less than 1 and rising.
    """
    made = np.ones(KATZ + 2)
    most = (KATZ + 1) * n.get(KATZ + 1, 0) / n[1] if n.get(1) else 1.0
    for r in range(1, KATZ + 1):
        d = 0.0
        if n.get(r) and most < 1:
            d = ((r + 1) * n.get(r + 1, 0) / (r * n[r]) - most) / (1 - most)
        made[r] = d if 0 < d < 1 else 1 - 1 / (2 * r + 2)
    return made


def context_sums(pairs: np.ndarray, counts: np.ndarray, levels: Levels, d: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per context of sorted pairs: its number, its pairs' tokens, their discounted tokens, their base probability."""
    if not len(pairs):
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    context = pairs >> 32
    edges = np.flatnonzero(np.diff(context, prepend=-1))
    kept = counts * d[np.minimum(counts, KATZ + 1)]
    base = levels.base(pairs & UNKNOWN)
    return context[edges], np.add.reduceat(counts, edges), np.add.reduceat(kept, edges), np.add.reduceat(base, edges)


def weights(tokens: np.ndarray, kept: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """s(h) and alpha(h) of each context: what seen pairs are scaled by, and the unseen words' share over theirs."""
    left = 1 - kept / tokens
    least = 1 / (2 * tokens + 2)
    scale = np.where(left < least, (1 - least) / np.maximum(kept / tokens, 1e-300), 1.0)
    return scale, np.maximum(left, least) / np.maximum(1 - base, 1e-300)


def context_table(pairs: DataFrame, levels: Levels, d: np.ndarray, most: int) -> DataFrame:
    """bucket, contexts (sorted), tokens, scale, alpha: normalised backoff weights of all but the HOT contexts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples(index=False):
                context, tokens, kept, base = context_sums(unpack(row.pairs), unpack_plain(row.counts, np.int64), levels, d)
                own = context > most
                scale, alpha = weights(tokens[own], kept[own], base[own])
                yield pd.DataFrame({"bucket": [row.bucket], "contexts": [pack(context[own])], "tokens": [pack_plain(tokens[own])],
                                    "scale": [pack_plain(scale)], "alpha": [pack_plain(alpha)]})

    return pairs.mapInPandas(run, "bucket int, contexts binary, tokens binary, scale binary, alpha binary")


def hot_contexts(pairs: DataFrame, levels: Levels, d: np.ndarray, most: int) -> list[tuple[int, int, float, float]]:
    """context, tokens, scale, alpha of BEGIN and the HOT commonest words: HOT + 1 rows at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples(index=False):
                found, counts = unpack(row.pairs), unpack_plain(row.counts, np.int64)
                own = found >> 32 <= most
                yield pd.DataFrame(dict(zip(("context", "tokens", "kept", "base"), context_sums(found[own], counts[own], levels, d), strict=True)))

    summed = pairs.mapInPandas(run, "context long, tokens long, kept double, base double").groupBy("context").agg(
        F.sum("tokens").alias("tokens"), F.sum("kept").alias("kept"), F.sum("base").alias("base")).orderBy("context").toPandas()
    scale, alpha = weights(*(summed[c].to_numpy(float) for c in ("tokens", "kept", "base")))
    return list(zip(summed["context"].tolist(), summed["tokens"].tolist(), scale.tolist(), alpha.tolist(), strict=True))


def answered(told: DataFrame, contexts: DataFrame) -> DataFrame:
    """bucket, shard, seen (each asked pair's count), tokens, scale, alpha (of each asked context, in order)."""
    kinds = {"tokens": (np.int64, 0), "scale": (float, 1.0), "alpha": (float, 1.0)}

    def run(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        context = unpack(held["contexts"].iloc[0]) if len(held) else np.zeros(0, np.int64)
        values = {n: unpack_plain(held[n].iloc[0], k) if len(held) else np.zeros(0, k) for n, (k, _) in kinds.items()}
        wanted = [unpack(c) for c in asked["contexts"]]
        made = {n: [pack_plain(looked_up(context, values[n], own, missing).astype(k)) for own in wanted]
                for n, (k, missing) in kinds.items()}
        return pd.DataFrame({"bucket": asked["bucket"], "shard": asked["shard"], "seen": asked["seen"], **made})

    return told.select("bucket", "shard", "seen", "contexts").groupBy("bucket").cogroup(contexts.groupBy("bucket")).applyInPandas(
        run, "bucket int, shard long, seen binary, tokens binary, scale binary, alpha binary")


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


class PairLevel:
    """A shard's tokens with what its buckets have answered about their pairs."""

    def __init__(self, row: dict, buckets: int, levels: Levels, d: np.ndarray, hot: tuple[np.ndarray, list[np.ndarray]], most: int):
        pairs, self.teaches, self.starts, self.word = pairs_of(row)
        self.known = np.flatnonzero(pairs >> np.uint64(32) != UNKNOWN)
        self.distinct, self.number = np.unique(pairs[self.known], return_inverse=True)
        distinct = self.distinct
        # of each distinct pair the probability, or of a pair not seen its context's weight, as logarithms
        made, self.seen = np.empty(len(distinct)), np.zeros(len(distinct), np.int64)
        own = {a["bucket"]: a for a in row.pop("answers") or ()}
        for b, at in by_bucket(pair_bucket(distinct, buckets, most)):
            seen = unpack_plain(own[b]["seen"], np.int64)
            of = (distinct[at] >> np.uint64(32)).astype(np.int64)
            _, place = np.unique(of, return_inverse=True)
            tokens, scale, alpha = (unpack_plain(own[b][n], k)[place] for n, k in (("tokens", np.int64), ("scale", float), ("alpha", float)))
            often = of <= most
            tokens, scale, alpha = (np.where(often, looked_up(hot[0], given, of, missing), value) for value, given, missing
                                    in zip((tokens, scale, alpha), hot[1], (1, 1, 1), strict=True))
            share = scale * d[np.minimum(seen, KATZ + 1)] * seen / np.maximum(tokens, 1)
            made[at] = np.log10(np.where(seen > 0, share, alpha))
            self.seen[at] = seen
        self.base = np.log10(levels.base(self.word.astype(np.int64)))
        self.log = self.base.copy()
        self.log[self.known] = made[self.number] + np.where(self.seen[self.number] > 0, 0.0, self.base[self.known])


def of_hot(hot: list[tuple]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Numbers of the hot contexts, and their tokens, scale and alpha."""
    return np.array([h[0] for h in hot], np.int64), [np.array([h[i] for h in hot], float) for i in (1, 2, 3)]


def score_rows(batch: pa.RecordBatch, i: int, held: bytes, level: PairLevel, log: np.ndarray) -> pa.RecordBatch:
    begin = level.starts[:-1]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_ids")[i].values, pa.array(np.frombuffer(held, np.uint8) == 1), pa.array(np.diff(level.starts)),
         pa.array(np.add.reduceat((level.word != UNKNOWN).astype(np.int64), begin)), pa.array(np.add.reduceat(level.base, begin)),
         pa.array(np.add.reduceat(log, begin))],
        ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def scored_schema(parts: DataFrame) -> str:
    kind = dict(parts.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")
    return f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def with_answers(parts: DataFrame, answers: DataFrame, *columns: str, name: str = "answers") -> DataFrame:
    """The shards with all that their buckets have answered."""
    collected = answers.groupBy("shard").agg(F.collect_list(F.struct("bucket", *columns)).alias(name))
    return parts.join(collected, "shard", "left")


ANSWERED = ("seen", "tokens", "scale", "alpha")


def score_shards(parts: DataFrame, answers: DataFrame, buckets: int, levels: Levels, d: np.ndarray,
                 hot: list[tuple[int, int, float, float]], most: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score, score."""
    often = of_hot(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("held", "starts", "codes", "numbers", "answers")}
                level = PairLevel(row, buckets, levels, d, often, most)
                yield score_rows(batch, i, row["held"], level, level.log)

    return with_answers(parts, answers, *ANSWERED).mapInArrow(tidy(run), scored_schema(parts))


class Triples:
    """A shard's triples (pair before, word): those whose pair stands in other shards' training texts too are asked for.

    Of the others all is known here. A text's first token has no pair before it, and a pair never seen gives no context.
    """

    def __init__(self, level: PairLevel, tokens: int, often: int):
        pair = np.full(len(level.word), -1, np.int64)
        pair[level.known] = level.number
        context = np.full(len(level.word), -1, np.int64)
        context[1:] = pair[:-1]
        context[level.starts[:-1]] = -1
        there = np.flatnonzero(context >= 0)
        there = there[level.seen[context[there]] > 0]
        self.there = there
        self.distinct, first, self.number = np.unique(
            context[there].astype(np.uint64) << np.uint64(32) | level.word[there], return_index=True, return_inverse=True)
        self.counts = np.bincount(self.number, weights=level.teaches[there], minlength=len(self.distinct)).astype(np.int64)
        self.lower = 10.0 ** level.log[there[first]]
        self.context = (self.distinct >> np.uint64(32)).astype(np.int64)  # the number of a distinct pair of the shard
        self.word = self.distinct & np.uint64(UNKNOWN)
        own = np.bincount(level.number, weights=level.teaches[level.known], minlength=len(level.distinct)).astype(np.int64)
        self.alone = level.seen == own
        self.hot = level.seen * often > tokens
        self.asked = np.flatnonzero(~self.alone[self.context])

    def buckets(self, level: PairLevel, buckets: int) -> np.ndarray:
        """Bucket of each asked triple: by its pair, or spread by pair and word where the pair is one of the HOT commonest."""
        pairs, words = level.distinct[self.context[self.asked]], self.word[self.asked]
        spread = np.where(self.hot[self.context[self.asked]], mixed(words + np.uint64(1)), np.uint64(0))
        return bucket_of(mixed(pairs) ^ spread ^ np.uint64(9), buckets)


def few_counts(context: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """For each of n contexts how many of its triples are seen r times, r from 1 to KATZ."""
    own = (counts > 0) & (counts <= KATZ)
    return np.bincount(context[own] * KATZ + counts[own] - 1, minlength=n * KATZ).reshape(n, KATZ).astype(np.int64)


QUESTION = "bucket int, shard long, contexts binary, hot binary, triples binary, counts binary, lower binary, alone array<long>"


def triple_questions(parts: DataFrame, answers: DataFrame, buckets: int, levels: Levels, d: np.ndarray, hot: list[tuple], most: int,
                     common: int, triple_buckets: int) -> DataFrame:
    """What each shard asks of each bucket: pairs, triples by the place of their pair, counts, probability by the pair before.

    ``alone``: numbers of the triples that need no answer, by count up to KATZ + 1; in one row of each shard.
    """
    often = of_hot(hot)
    names = [f.split()[0] for f in QUESTION.split(", ")]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("shard", "held", "starts", "codes", "numbers", "answers")}
                level = PairLevel(row, buckets, levels, d, often, most)
                t = Triples(level, levels.tokens, common)
                settled = t.counts[t.alone[t.context]]
                alone = np.bincount(settled[(settled > 0) & (settled <= KATZ + 1)], minlength=KATZ + 2).tolist()
                made = []
                for b, at in by_bucket(t.buckets(level, triple_buckets)):
                    own = t.asked[at]
                    contexts, place = np.unique(t.context[own], return_inverse=True)
                    made.append((b, row["shard"], pack(level.distinct[contexts].view(np.int64)), np.packbits(t.hot[contexts]).tobytes(),
                                 pack((place.astype(np.int64) << 32) | t.word[own].astype(np.int64)), pack_plain(t.counts[own]),
                                 pack_plain(t.lower[own]), None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*made, (0, -1, b"", b"", b"", b"", b"", alone), strict=True), kinds, strict=True)], names)

    return with_answers(parts, answers, *ANSWERED).mapInArrow(tidy(run), QUESTION)


TRIPLED = ("kind string, bucket int, shard long, seen binary, few binary, lower binary, counted array<long>, "
           "hot_pairs binary, hot_few binary, hot_lower binary")


def triple_table(questions: DataFrame) -> DataFrame:
    """kind 'answer': for each question the counts of its triples, and of its pairs ``few_counts`` and the lower probability
    of all that was seen after them. kind 'model': numbers of triples by count, and the sums of this bucket's part of hot pairs."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        counted = np.zeros(KATZ + 2, np.int64)
        for alone in frame["alone"]:
            if alone is not None:
                counted += np.asarray(alone, np.int64)
        frame = frame[frame["shard"] >= 0]
        asked = [unpack(c) for c in frame["contexts"]]
        pairs = np.unique(np.concatenate(asked)) if asked else np.zeros(0, np.int64)
        hot = np.zeros(len(pairs), bool)
        places, keys = [np.searchsorted(pairs, own) for own in asked], []
        for at, bits, triples in zip(places, frame["hot"], frame["triples"], strict=True):
            hot[at] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=len(at)).astype(bool)
            own = unpack(triples)
            keys.append(at[own >> 32] << 32 | own & UNKNOWN)
        distinct, first, number = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_index=True, return_inverse=True)
        counts = np.bincount(number, weights=np.concatenate([unpack_plain(c, np.int64) for c in frame["counts"]]) if keys else None,
                             minlength=len(distinct)).astype(np.int64)
        lower = np.concatenate([unpack_plain(v, float) for v in frame["lower"]])[first] if keys else np.zeros(0)
        context = distinct >> 32
        few = few_counts(context, counts, len(pairs))
        summed = np.bincount(context, weights=np.where(counts > 0, lower, 0.0), minlength=len(pairs))
        own = counts[(counts > 0) & (counts <= KATZ + 1)]
        counted += np.bincount(own, minlength=KATZ + 2)
        ends = np.cumsum([len(k) for k in keys])[:-1] if keys else []
        answers = [(int(b), int(shard), pack_plain(counts[n]), pack_plain(few[at].ravel()), pack_plain(summed[at]))
                   for b, shard, n, at in zip(frame["bucket"], frame["shard"], np.split(number, ends) if keys else [], places, strict=True)]
        rows = [("answer", *a, None, None, None, None) for a in answers]
        rows.append(("model", 0, 0, None, None, None, counted.tolist(), pack(pairs[hot]), pack_plain(few[hot].ravel()), pack_plain(summed[hot])))
        return pd.DataFrame(rows, columns=[f.split()[0] for f in TRIPLED.split(", ")])

    return questions.groupBy("bucket").applyInPandas(run, TRIPLED)


def hot_pairs(models: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The HOT commonest pairs at most: numbers, few_counts and lower probability, added up over the buckets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples(index=False):
                few = unpack_plain(row.hot_few, np.int64).reshape(-1, KATZ)
                yield pd.DataFrame({"pair": unpack(row.hot_pairs), "lower": unpack_plain(row.hot_lower, float)} | {
                    f"n{r}": few[:, r] for r in range(KATZ)})

    counted = ", ".join(f"n{r} long" for r in range(KATZ))
    summed = models.select("hot_pairs", "hot_few", "hot_lower").mapInPandas(run, f"pair long, lower double, {counted}").groupBy("pair").agg(
        F.sum("lower").alias("lower"), *(F.sum(f"n{r}").alias(f"n{r}") for r in range(KATZ))).orderBy("pair").toPandas()
    return (summed["pair"].to_numpy(np.int64), summed[[f"n{r}" for r in range(KATZ)]].to_numpy(np.int64).reshape(-1, KATZ),
            summed["lower"].to_numpy(float))


def score_triples(parts: DataFrame, pair_answers: DataFrame, buckets: int, levels: Levels, d: np.ndarray, hot: list[tuple], most: int,
                  common: int, triple_buckets: int) -> DataFrame:
    """``score_shards`` with contexts of two words: from the triple to the pair to the word, as far as each was seen."""
    pair_answers = written(pair_answers, "pair-answers")
    met = written_by(triple_table(triple_questions(parts, pair_answers, buckets, levels, d, hot, most, common, triple_buckets)), "triples", "kind")
    models = met.where("kind = 'model'")
    by_count = models.select(F.posexplode("counted").alias("count", "n")).groupBy("count").agg(F.sum("n").alias("n")).collect()
    d3 = discounts({r["count"]: r["n"] for r in by_count if r["count"]})
    often, commonest = of_hot(hot), hot_pairs(models)
    both = with_answers(with_answers(parts, pair_answers, *ANSWERED), met.where("kind = 'answer'"), "seen", "few", "lower", name="triples")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.arange(1, KATZ + 1)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("held", "starts", "codes", "numbers", "answers", "triples")}
                level = PairLevel(row, buckets, levels, d, often, most)
                t = Triples(level, levels.tokens, common)
                n = len(level.distinct)
                seen, few = t.counts.copy(), few_counts(t.context, t.counts, n)
                lower = np.bincount(t.context, weights=np.where(t.counts > 0, t.lower, 0.0), minlength=n)
                own = {a["bucket"]: a for a in row.pop("triples") or ()}
                for b, at in by_bucket(t.buckets(level, triple_buckets)):
                    asked = t.asked[at]
                    contexts = np.unique(t.context[asked])
                    seen[asked] = unpack_plain(own[b]["seen"], np.int64)
                    few[contexts] = unpack_plain(own[b]["few"], np.int64).reshape(-1, KATZ)
                    lower[contexts] = unpack_plain(own[b]["lower"], float)
                spread = np.flatnonzero(t.hot & ~t.alone)
                if len(spread) and len(commonest[0]):
                    place = np.minimum(np.searchsorted(commonest[0], level.distinct[spread].view(np.int64)), len(commonest[0]) - 1)
                    real = commonest[0][place] == level.distinct[spread].view(np.int64)
                    few[spread[real]], lower[spread[real]] = commonest[1][place[real]], commonest[2][place[real]]
                tokens = np.maximum(level.seen, 1)
                kept = (few * times * d3[1:KATZ + 1]).sum(axis=1) + level.seen - (few * times).sum(axis=1)
                scale, alpha = weights(tokens, kept, lower)
                share = scale[t.context] * d3[np.minimum(seen, KATZ + 1)] * seen / tokens[t.context]
                made = np.log10(np.where(seen > 0, share, alpha[t.context]))
                log = level.log.copy()
                log[t.there] = made[t.number] + np.where(seen[t.number] > 0, 0.0, level.log[t.there])
                yield score_rows(batch, i, row["held"], level, log)

    return both.mapInArrow(tidy(run), scored_schema(parts))


def bucketed(rows: DataFrame) -> tuple[DataFrame, str]:
    """The rows written in buckets by shard, and where: later joins by shard leave them where they are.

    Buckets need a table to be defined by; its name goes again at once, as the files are all that is read.
    """
    spark = rows.sparkSession
    path = fresh_folder(spark, "shards")
    name = f"shards_{uuid.uuid4().hex}"
    rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard").format("parquet").option("path", path).saveAsTable(name)
    held = spark.table(name)
    held.schema  # resolved now, before its name goes  # noqa: B018
    spark.sql(f"DROP TABLE {name}")
    return held, path


def written_by(rows: DataFrame, label: str, column: str) -> DataFrame:
    """``session.written`` with a folder for each value of a column."""
    path = fresh_folder(rows.sparkSession, label)
    rows.write.partitionBy(column).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def model(parts: DataFrame, most: int = HOT):
    """The shards in numbers, and the model's tables: levels, discounts, contexts, hot contexts, what shards are told."""
    total = parts.agg(F.coalesce(F.sum(F.octet_length("vocabulary")), F.lit(0))).first()[0] // 8
    word_buckets = max(1, -(-total // BUCKET_ITEMS))
    words = written(word_table(word_questions(parts, word_buckets)), "words")
    levels = Levels([(r["count"], r["n"]) for r in counts_of_counts(words).collect()])
    coded, _ = bucketed(in_numbers(parts, numbered(word_questions(parts, word_buckets), words, levels), word_buckets))
    pair_buckets = max(1, -(-5 * total // BUCKET_ITEMS))
    met = written_by(pair_table(pair_questions(coded, pair_buckets, most)), "pairs", "kind")
    pairs = met.where("kind = 'model'").select("bucket", "pairs", "counts")
    d = discounts({r["count"]: r["n"] for r in counts_of_counts(pairs).where(F.col("count") <= KATZ + 1).collect()})
    contexts = written(context_table(pairs, levels, d, most), "contexts")
    return coded, levels, d, contexts, hot_contexts(pairs, levels, d, most), met.where("kind = 'answer'"), pair_buckets


def scores(docs: DataFrame, modulus: int = 10, remainder: int = 0, most: int = HOT, order: int = ORDER,
           common: int = HOT) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score by contexts of ``order`` - 1 words.

    ``most`` words and pairs that are more than one in ``common`` tokens are spread over all buckets.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    parts, path = bucketed(shards(docs, held_out("doc_id", modulus, remainder)))
    coded, levels, d, contexts, hot, told, buckets = model(parts, most)
    remove_folder(docs.sparkSession, path)  # the numbered shards have taken its place
    if order == 2:
        made = score_shards(coded, answered(told, contexts), buckets, levels, d, hot, most)
    else:
        made = score_triples(coded, answered(told, contexts), buckets, levels, d, hot, most, common, buckets)
    return made.withColumn("train_tokens", F.lit(levels.tokens).cast("long"))
