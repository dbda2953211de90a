"""The registered queries against their SQL and brute force, and the pipeline stage by stage."""

import brute
import numpy as np
import pytest
from parity import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import jaccard, tokens
from gleaner.llm.common import stage
from gleaner.llm.oracle import ORACLE
from gleaner.llm.queries import REGISTERED


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_rows(spark, small, name):
    assert difference(REGISTERED[name](spark, small).toPandas(), connect(small).execute(ORACLE[name]).df()) is None


def test_every_operator_has_a_query():
    assert [sum(q.startswith(f"op{n}_") for q in REGISTERED) for n in range(1, 14)] == [1] * 13


def table(spark, folder, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select(*columns).collect()]


def test_jaccard_query(spark, small):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in REGISTERED["op2_jaccard_join"](spark, small).collect()}
    assert got == brute.jaccard_links(table(spark, small, "documents", "doc_id", "text"))


def test_packing_query(spark, small):
    got = REGISTERED["op1_packing"](spark, small).collect()
    own = tokens.encoder(tokens.Vocabulary.byte_bpe_50k()).exact
    ids = {d: [*own.encode(t or "", add_special_tokens=False).ids, 0] for d, t in table(spark, small, "documents", "doc_id", "text")}
    import zlib

    used = {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id]) and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert sum(used.values()) == sum(map(len, ids.values())) and max(used.values()) <= 1024
    assert sum(1024 - n for n in used.values()) <= 1024


def test_language_query(spark, small):
    got = REGISTERED["op8_language"](spark, small).collect()
    assert len(got) == len(table(spark, small, "documents", "doc_id"))


def test_training_order_query(spark, small):
    got = REGISTERED["op5_training_order"](spark, small).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))


def test_pipeline_stages(spark, small):
    """Each stage against brute force on what the stage before it kept."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    kept = stage(steps["quality rules"](spark, docs, small), "t")
    assert kept.columns == docs.columns
    judged = {d: brute.statistics(t) for d, t in table(spark, small, "documents", "doc_id", "text")}
    names = {r.doc_id for r in kept.collect()}
    assert names <= {d for d, s in judged.items() if not s[-1]} and len(names) > 0.8 * len(judged)

    before = {r.doc_id: r.text for r in kept.collect()}
    groups = brute.jaccard(list(before.items()))
    single = stage(steps["n-gram Jaccard join"](spark, kept, small), "t")
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, (_, c) in groups.items() if c == d)

    before = {r.doc_id: r.text for r in single.collect()}
    cut = stage(steps["substring dedup"](spark, single, small), "t")
    assert cut.columns == docs.columns
    want = {d: (n, gone, sha) for d, n, gone, sha in brute.repeats(list(before.items()))}
    for r in cut.collect():
        n, gone, sha = want[r.doc_id]
        assert r.text == before[r.doc_id] if not gone else brute.sha(r.text) == sha
        assert r.n_chars == len(r.text)

    clean = stage(steps["benchmark decontamination"](spark, cut, small), "t")
    items = table(spark, small, "benchmark", "item_id", "text")
    assert not any(x[-1] for x in brute.contamination([(r.doc_id, r.text) for r in clean.collect()], items))
    hit = {x[0] for x in brute.contamination([(r.doc_id, r.text) for r in cut.collect()], items) if x[-1]}
    same = {r.doc_id: r.text for r in cut.collect()}
    after = {r.doc_id: r.text for r in clean.collect()}
    assert set(same) - hit <= set(after) and all(after[d] == same[d] for d in after if d not in hit)

    packed = steps["packing"](spark, clean, small)
    own = tokens.encoder(tokens.Vocabulary.byte_bpe_50k()).exact
    total = sum(len(own.encode(t, add_special_tokens=False).ids) + 1 for t in after.values())
    assert packed.agg(F.sum("length")).first()[0] == total


def test_near_copies_of_the_pipeline_are_one_group(spark, small):
    rows = jaccard.similar_sets(spark.read.parquet(f"{small}/documents.parquet"))
    assert rows.filter("component_id > doc_id").count() == 0
