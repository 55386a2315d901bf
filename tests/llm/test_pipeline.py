import os

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from dayloom.llm import queries, suffix, toxicity
from llm_rows import CLASHES, odd_rows, prose, table
from test_neardup import brute as near_groups
from test_toxicity import corpus

TABLES = "/root/testdata/sf0.01"


def kept_texts(rows):
    """Characters of which a byte is not covered by an earlier string of LENGTH bytes, by a dictionary of all windows."""
    seen, kept = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - suffix.LENGTH + 1):
            window = data[at:at + suffix.LENGTH]
            if window in seen:
                gone[at:at + suffix.LENGTH] = b"x" * suffix.LENGTH
            seen.add(window)
        at, out = 0, []
        for char in text or "":
            size = len(char.encode())
            if not all(gone[at:at + size]):
                out.append(char)
            at += size
        kept[doc_id] = "".join(out)
    return kept


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "MinHash near-dedup", "suffix-array dedup", "best-fit packing"]


def test_each_stage_takes_effect_on_its_input(spark, tmp_path):
    rows, marks = corpus(300)
    passage = prose(77, 80)
    rows += [(1000 + i, rows[i][1]) for i in range(10)] + [(2000, passage + " " + prose(78, 40)), (2001, prose(79, 60) + " " + passage)]
    rows += [(3000 + k, t) for k, (i, t) in enumerate(odd_rows()) if i not in (7, 8)]
    spark.createDataFrame(marks, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, rows, clash=True)
    state = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        made = stage(spark, docs, str(tmp_path))
        made.write.parquet(f"{tmp_path}/{name.replace(' ', '-')}")
        docs = spark.read.parquet(f"{tmp_path}/{name.replace(' ', '-')}")
        state[name] = (before, docs)
        if name != "best-fit packing":
            assert docs.columns == before.columns and docs.columns[-len(CLASHES):] == CLASHES
    toxic_in, toxic_out = state["toxicity"]
    judged = toxicity.scores(toxic_in.withColumn("body", toxic_in["text"]), spark.createDataFrame(marks, "doc_id long, toxic int"), "body").collect()
    clean = sorted(((r.doc_id, r.body or "") for r in judged if not r.predicted), key=repr)
    assert sorted(((r.doc_id, r.text or "") for r in toxic_out.collect()), key=repr) == clean
    gone = {r.doc_id for r in toxic_in.collect()} - {r.doc_id for r in toxic_out.collect()}
    bad = {i for i, y in marks if y}
    assert len(gone & bad) > 0.8 * len(bad) and len(gone - bad) < 40
    before, after = state["exact dedup"]
    best = {}
    for r in before.collect():
        best[r.text or ""] = max(best.get(r.text or "", -1), r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(best.values())
    before, after = state["MinHash near-dedup"]
    expected = [g[0] for g in near_groups([(r.doc_id, r.text) for r in before.collect()], 5, 80) if g[3]]
    assert sorted(r.doc_id for r in after.collect()) == sorted(expected)
    before, after = state["suffix-array dedup"]
    assert after.count() == before.count()
    texts = {r.doc_id: r for r in after.collect()}
    assert passage in texts[2000].text and passage not in texts[2001].text
    cut = kept_texts([(r.doc_id, r.text) for r in before.collect()])
    assert {i: r.text or "" for i, r in texts.items()} == cut
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in texts.values())
    before, after = state["best-fit packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before.collect()}
    own = {}
    for r in after.collect():
        own[r.doc_id] = own.get(r.doc_id, 0) + r.length
    assert own == tokens


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="the provided tables are not there")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_its_sql(spark, name):
    import oracle

    assert oracle.compare(spark, oracle.connect(TABLES), TABLES, name, queries.QUERIES[name], queries.SQL[name]) is None


def test_all_are_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names
