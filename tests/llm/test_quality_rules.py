import collections
import re

from dayloom.llm import quality
from llm_rows import collected, odd_rows, prose, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def rows_():
    repeated = prose(5, 12)
    return odd_rows() + [(20, f"{repeated}\n{repeated}\n\n \n{repeated}"), (21, "### $$ a|b <c> " * 30), (22, "SHOUT LOUD " * 40),
                         (23, "a b c d e f g h a b c d e f g h a"), (24, "x " * 7), (25, "x " * 8), (26, "x " * 9)]


def test_measurements_agree_with_brute_force(spark):
    rows = rows_()
    got = quality.ledger(table(spark, rows, clash=True)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert collected(got) == sorted(((i, *brute(t or "")) for i, t in rows), key=repr)


def test_policies_read_bits_only(spark):
    entries = quality.ledger(table(spark, rows_())).cache()
    for version in quality.POLICIES:
        for r in quality.apply_policy(entries, version).collect():
            base = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
            assert r.base_failed == base
            assert r.kept == (not base and r.failed & quality.mask(quality.POLICIES[version]) == 0)


def test_ablations_agree_with_counting(spark):
    entries = quality.ledger(table(spark, rows_())).cache()
    failed = [r.failed & quality.mask(quality.POLICIES["v2"]) for r in entries.collect()]
    for r in quality.ablations(entries, "v2").collect():
        bit = quality.mask([r.rule])
        assert (r.n_failed, r.n_failed_alone, r.n_kept_without) == (
            sum(f & bit != 0 for f in failed), sum(f == bit for f in failed), sum(f & ~bit == 0 for f in failed))


def test_empty_table(spark):
    assert quality.apply_policy(quality.ledger(table(spark, [])), "v2").collect() == []
