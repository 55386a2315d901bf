"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from dayloom.llm import (
    bpe, exact, html, katz, langid, licenses, neardup, packing, quality, suffix, toxicity, trie, whitening)
from dayloom.llm.common import table
from dayloom.session import written

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_best_fit_packing")
def best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


@query("op2_katz_backoff")
def katz_scores(spark, sf_dir):
    return katz.scores(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUALITY_SQL = r"""
    WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                      list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
               FROM documents),
    win AS (SELECT doc_id, i, words[i:i + 7] AS win FROM w, unnest(range(1, greatest(1, len(words) - 6))) t(i)),
    dup AS (SELECT doc_id, win FROM win GROUP BY ALL HAVING count(*) > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM win JOIN dup USING (doc_id, win), unnest(range(0, 8)) u(j) GROUP BY doc_id),
    m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
                 CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
                 len(lines) AS n_lines,
                 len(list_filter(words, lambda x: regexp_matches(x, '[A-Z]{2}') AND NOT regexp_matches(x, '[a-z]'))) AS n_capital_words,
                 len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words
          FROM w LEFT JOIN covered USING (doc_id)),
    f AS (SELECT *, CAST(RULE_BITS AS BIGINT) AS failed FROM m)""".replace("RULE_BITS", " + ".join(
    f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(quality.RULES.values())))
POLICY = quality.mask(quality.POLICIES["v2"])


@query("op3_quality_rules", f"""{QUALITY_SQL}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {quality.mask(quality.BASE)}) <> 0 AS base_failed,
           (failed & {POLICY}) = 0 AS kept, failed FROM f""")
def quality_rules(spark, sf_dir):
    entries = written(quality.ledger(table(spark, sf_dir, "documents")), "ledger")
    return quality.apply_policy(entries, "v2").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


@query("quality_ablations", QUALITY_SQL + " UNION ALL ".join(f"""
    SELECT '{rule}' AS rule, count(*) FILTER (failed & {quality.mask([rule])} <> 0) AS n_failed,
           count(*) FILTER (failed & {POLICY} = {quality.mask([rule])}) AS n_failed_alone,
           count(*) FILTER (failed & {POLICY & ~quality.mask([rule])} = 0) AS n_kept_without FROM f"""
    for rule in quality.POLICIES["v2"]))
def quality_ablations(spark, sf_dir):
    """What each rule of the policy rejects, alone and with others, from the ledger's bits."""
    entries = written(quality.ledger(table(spark, sf_dir, "documents")), "ledger")
    return quality.ablations(entries, "v2")


@query("op4_suffix_array_dedup", """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
    win AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s FROM d, unnest(range(0, greatest(0, n - 99))) t(p)),
    marked AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS r FROM win) WHERE r > 1),
    starts AS (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM marked),
    numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM starts),
    spans AS (SELECT doc_id, k, min(p) AS low, max(p) + 100 AS high FROM numbered GROUP BY doc_id, k),
    gaps AS (SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS low, low AS high FROM spans
             UNION ALL SELECT d.doc_id, coalesce(max(s.high), 0), any_value(d.n) FROM d LEFT JOIN spans s USING (doc_id) GROUP BY d.doc_id),
    kept AS (SELECT doc_id, string_agg(substr(h, 2 * low + 1, 2 * (high - low)), '' ORDER BY low) AS h FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
    summed AS (SELECT doc_id, CAST(sum(high - low) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
    SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
    FROM d JOIN kept USING (doc_id) LEFT JOIN summed USING (doc_id)""")
def suffix_array_dedup(spark, sf_dir):
    return suffix.removals(table(spark, sf_dir, "documents"))


@query("op5_minhash_near_dup", r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
    sh AS (SELECT DISTINCT doc_id, words[i:i + 3] AS s FROM w, unnest(range(1, greatest(2, len(words) - 2))) t(i) WHERE len(words) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT sides.b, reach.c FROM reach JOIN sides ON reach.doc_id = sides.a),
    lowest AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM lowest LEFT JOIN sizes USING (doc_id)""")
def minhash_near_dup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


@query("op6_bpe")
def bpe_round_trip(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


@query("op7_html_text")
def html_text(spark, sf_dir):
    return html.main_text(table(spark, sf_dir, "pages"))


@query("op8_toxicity")
def toxic_scores(spark, sf_dir):
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_exact_dedup", """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
         g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
    FROM d JOIN g USING (text)""")
def exact_dedup(spark, sf_dir):
    return exact.groups(table(spark, sf_dir, "documents"))


@query("op10_license_scan")
def license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_spans")


# crc32 of the decimal id, bit by bit.
CRC_SQL = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS UBIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda k: CAST(k AS UBIGINT))),
        lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS UBIGINT)) ELSE x // 2 END)))"""


@query("op11_conversation_trie", f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
                      sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark
               FROM conversations WHERE conv_id IS NOT NULL),
    seqs AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, mark) AS turns FROM t GROUP BY conv_id),
    heads AS (SELECT *, CAST({CRC_SQL} % 9 AS BIGINT) AS h, conv_id - conv_id % 5 AS first_id FROM seqs),
    re AS (SELECT a.conv_id, list_concat(coalesce(b.turns[1:h], []), a.turns[h + 1:]) AS turns
           FROM heads a LEFT JOIN seqs b ON b.conv_id = a.first_id),
    pre AS (SELECT conv_id, d, turns[1:d] AS p, len(turns) = d AS ends FROM re, unnest(range(0, len(turns) + 1)) u(d)),
    node AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
                    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(p[d].text) END AS own FROM pre GROUP BY p, d),
    up AS (SELECT c.p, min(q.conv_id) AS parent_conv_id FROM node c JOIN node q ON q.d = c.d - 1 AND q.p = c.p[1:c.d - 1] GROUP BY c.p),
    kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
    known AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (p)),
    below AS (SELECT p[1:k] AS p, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(own) AS saved
              FROM known, unnest(range(0, d + 1)) u(k) GROUP BY ALL)
    SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
           CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
    FROM known JOIN below USING (p) LEFT JOIN up USING (p)""")
def conversation_trie(spark, sf_dir):
    return trie.trie(trie.rebuilt(table(spark, sf_dir, "conversations")))


@query("op12_language_id")
def language_id(spark, sf_dir):
    return langid.languages(table(spark, sf_dir, "documents"))


@query("op13_embedding_whitening")
def embedding_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"), most=4).withColumn(
        "deviation", F.col("deviation").try_cast("long"))
