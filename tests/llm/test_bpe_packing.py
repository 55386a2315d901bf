import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from dayloom.llm import bpe, packing
from llm_rows import collected, odd_rows, prose, table

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["the", "ing", "'s", "'LL", "don't", "é", "É", "ß", "İ", "Σ", "ΑΣ", " ", "  ", "　", "\n", "\t", "\x1c", "日本", "語", "😀", "12",
         "½", "<|endoftext|>", "<|startoftext|>", "<|end", "|", "_", "-", "ﬁ", "한", "ᄒ", "ᅡ", "x", "A", "́", "‍", "th", "\x85",
         "٣", "\x00", "ŉ", "'", "’s", "\xad", "\xa0"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_encoding_agrees_with_the_library(library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    texts += ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(1, 40))) for _ in range(4000)]
    texts += ["", " ", "a" * 500, prose(1, 3000)]
    ids, offsets = bpe.text_ids(pa.array(texts), PATH)
    for i, encoded in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        own = ids[offsets[i]:offsets[i + 1]]
        assert own.tolist() == encoded.ids, texts[i]
        assert bpe.decode(own, PATH) == library.decode(encoded.ids, skip_special_tokens=False)


def test_digests_agree_with_the_library(spark, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows, expected = odd_rows(), []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert collected(bpe.digests(table(spark, rows, clash=True), PATH)) == sorted(expected, key=repr)
    assert bpe.digests(table(spark, []), PATH).collect() == []
    assert {(r.doc_id, len(r.ids)) for r in bpe.encode_documents(table(spark, rows), PATH).collect()} == {(e[0], e[1]) for e in expected}


def check_slots(pieces, size):
    """Sequences hold at most ``size`` tokens, without gaps or overlaps."""
    sequences = {}
    for sequence, offset, length in pieces:
        sequences.setdefault(sequence, []).append((offset, length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_pack_agrees_with_the_library(spark, library):
    rows, expected, size = odd_rows(), [], 256
    for i, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        expected += [(i, k, k * size, len(p), zlib.crc32(p.tobytes())) for k in range(-(-len(ids) // size)) for p in [ids[k * size:(k + 1) * size]]]
    got = packing.pack(table(spark, rows, clash=True), PATH, size).collect()
    assert sorted((tuple(r[:5]) for r in got), key=repr) == sorted(expected, key=repr)
    used = check_slots([(r.sequence_id, r.offset, r.length) for r in got], size)
    assert used <= -(-sum(r.length for r in got) // size) + 1
    assert packing.pack(table(spark, []), PATH).collect() == []


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit(seed):
    """The plan fills as many sequences as best fit, longest first, piece by piece."""
    rng, size = random.Random(seed), 64
    counts = {length: rng.randint(1, 60) for length in rng.sample(range(1, size + 1), rng.randint(1, 20))}
    pieces = []
    for length, first, ranks, sequence, each, at in packing.plan(counts, size):
        pieces += [(sequence + k // each, at + k % each * length, length) for k in range(ranks)]
    assert {n: sum(1 for p in pieces if p[2] == n) for n in counts} == counts
    rooms = []
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fitting = [i for i, r in enumerate(rooms) if r >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(size - length)
    assert check_slots(pieces, size) == len(rooms)


def test_ranks_are_gapless_per_length_in_parts(spark):
    rows = spark.createDataFrame([(i, 0, i % 3) for i in range(500)], "doc_id long, piece int, length long")
    for parts in (1, 7):
        got = packing.ranked(rows, parts).collect()
        for length in range(3):
            own = sorted(r["rank"] for r in got if r["length"] == length)
            assert own == list(range(len(own)))


def test_small_steps_pack_alike(spark):
    frame = table(spark, [(i, prose(i, 300)) for i in range(40)])
    made = collected(packing.pack(frame, PATH).select("doc_id", "piece", "length", "ids_crc32"))
    assert collected(packing.pack(frame, PATH, batch=3, keep=False).select("doc_id", "piece", "length", "ids_crc32")) == made
