"""Quality rules as a ledger of bitmasks.

``ledger`` measures every text and evaluates every rule once; a row keeps the measurements and one bit per failed
rule. Policies are named sets of rules, so a new version of one, or an ablation, reads the ledger and never the texts.

Defined cases: a null or empty text has no words and fails ``few_words``; a null doc_id keeps its row; repeated rows
each get theirs; an empty table gives an empty ledger; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import counts_per, documents, owners, per_slice, word_codes

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capital_words",
            "n_letter_words", "n_bar_words")

#: Rules by bit; never reorder, only append. Each is true where a document fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "10 * word_chars < 20 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "capitals": "10 * n_capital_words > 5 * n_words",
    "few_letters": "10 * n_letter_words < 6 * n_words",
}
BASE = ("few_words", "repeated_windows")
#: Versions of the policy: the rules that a kept document must pass.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "duplicate_lines", "short_words", "long_words", "capitals"),
    "v3": (*BASE, "symbols", "duplicate_lines", "short_words", "long_words", "capitals", "few_letters"),
}


def repeated_words(codes: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Per text, words inside a run of ``size`` words that occurs twice or more in that text.

    Windows are told apart exactly: pairs of numbered runs are numbered anew, doubling their length.
    """
    n, total = len(offsets) - 1, len(codes)
    if total < size:
        return np.zeros(n, np.int64)
    owner = owners(offsets)
    ends = offsets[1:][owner]
    mark = np.zeros(total + 1, np.int64)
    run, length = codes, 1
    while length < size:
        step = min(length, size - length)
        pair = run[:len(run) - step] * np.int64(run.max() + 1) + run[step:]
        run = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        length += step
    starts = np.flatnonzero(np.arange(len(run)) + size <= ends[:len(run)])
    if not len(starts):
        return np.zeros(n, np.int64)
    key = run[starts] * np.int64(n) + owner[starts]
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = starts[times[inverse] > 1]
    np.add.at(mark, twice, 1)
    np.add.at(mark, twice + size, -1)
    return counts_per(owner, n, np.cumsum(mark)[:-1] > 0)


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of each text; see MEASURES."""
    n = len(texts)
    codes, offsets, vocabulary = word_codes(texts)
    owner = owners(offsets)

    def per_word(of_vocabulary: pa.Array) -> np.ndarray:
        return counts_per(owner, n, of_vocabulary.to_numpy(zero_copy_only=False).astype(np.float64)[codes])

    lines = pc.split_pattern(texts, "\n")
    coded = lines.flatten().dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    filled = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)[number]
    line_owner = owners(np.asarray(lines.offsets, dtype=np.int64))[filled]
    number = number[filled]
    n_lines = counts_per(line_owner, n)
    different = np.unique(line_owner * np.int64(max(1, len(coded.dictionary))) + number)
    distinct = counts_per(different // max(1, len(coded.dictionary)), n)
    shouted = pc.and_(pc.match_substring_regex(vocabulary, r"[A-Z]{2}"),
                      pc.invert(pc.match_substring_regex(vocabulary, r"[a-z]")))
    return {
        "n_words": np.diff(offsets), "word_chars": per_word(pc.utf8_length(vocabulary)),
        "n_symbols": pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": n_lines - distinct, "n_repeat_words": repeated_words(codes, offsets), "n_lines": n_lines,
        "n_capital_words": per_word(shouted),
        "n_letter_words": per_word(pc.match_substring_regex(vocabulary, r"\p{L}")),
        "n_bar_words": per_word(pc.equal(vocabulary, "|")),
    }


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements, in one pass without a shuffle."""
    frame = documents(docs)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        found = measure(part.column("text"))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(found[m], pa.int64()) for m in MEASURES)],
                                          ["doc_id", *MEASURES])

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(per_slice(run), f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))


def mask(rules: tuple[str, ...] | list[str]) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in rules)


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``failed``: bit k is set where the k-th rule fails."""
    bits: Column = F.lit(0).cast("long")
    for k, rule in enumerate(RULES.values()):
        bits = bits + F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
    return measured(docs).withColumn("failed", bits)


def apply_policy(entries: DataFrame, version: str) -> DataFrame:
    """``base_failed`` and ``kept`` by one version of the policy; reads bits only."""
    base = F.col("failed").bitwiseAND(F.lit(mask(BASE))) != 0
    wanted = F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0
    return entries.withColumns({"base_failed": base, "kept": ~base & wanted, "policy": F.lit(version)})


def ablations(entries: DataFrame, version: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that stay kept without it.

    The ledger is first counted by its bits, of which there are at most 2 ** rules.
    """
    rules, whole = POLICIES[version], mask(POLICIES[version])
    patterns = entries.groupBy(F.col("failed").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    one = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(mask([r])).cast("long").alias("bit"))
                              for r in rules)))
    spread = patterns.select("bits", "n", one.alias("r")).select("bits", "n", "r.rule", "r.bit")
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    without = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return spread.groupBy("rule").agg(total(fails).alias("n_failed"), total(alone).alias("n_failed_alone"),
                                      total(without).alias("n_kept_without"))
