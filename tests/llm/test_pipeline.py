import zlib

import numpy as np
import pytest
from conftest_llm import brute_components, shingle_set, words_of
from test_decontam import brute as brute_matches
from test_tokens import library

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, written and read again as the driver does."""
    from aerotrace.session import stage_table
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in corpus_pipeline.STAGES:
        out.append(stage_table(f(spark, out[-1], SF), name))
    return [df.collect() for df in out], [df.columns for df in out]


def test_columns(stages):
    _, columns = stages
    assert all(c == columns[0] for c in columns[:-1]) and "doc_id" in columns[-1]


def test_quality_keeps_clean_documents(spark, stages):
    (docs, kept, *_), _ = stages
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept}
    long = {r.doc_id for r in docs if len(words_of(r.text)) >= 50}
    assert all((d in ids) == (labels[d] == 1) for d in labels if d in long)


def test_near_dedup_keeps_one_of_each_group(stages):
    (_, before, after, *_), _ = stages
    comp = brute_components({r.doc_id: shingle_set(r.text, 5) for r in before})
    assert sorted(r.doc_id for r in after) == sorted(set(comp.values()))


def test_decontamination_drops_matches_only(spark, stages):
    (_, _, before, after, *_), _ = stages
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {d for d, _ in brute_matches([(r.doc_id, r.text) for r in before], items)}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - hit


def test_mix_meets_budgets(spark, stages):
    from aerotrace.llm.mixing import mix
    (_, _, _, before, after, _), _ = stages
    taken = {r.doc_id: r.taken for r in mix(spark.createDataFrame(before)).collect()}
    got = {}
    for r in after:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words_of(r.text))
    assert {d: n for d, n in got.items() if n} == {d: n for d, n in taken.items() if n}


def test_tokens_are_those_of_the_mix(stages):
    (*_, before, after), _ = stages
    texts = sorted((r.doc_id, r.text) for r in before)
    want, at = [], 0
    for (d, _), ids in zip(texts, library([t for _, t in texts])):
        ids = np.array(ids + [2], dtype="<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in after) == want


def test_documents_without_an_id_reach_the_token_files(spark):
    rows = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text and len(words_of(r.text)) >= 50]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    comp = brute_components({r.doc_id: shingle_set(r.text, 5) for r in rows[:60]})
    unique = [r for r in rows[:60] if comp[r.doc_id] == r.doc_id]
    with_id, without = unique[:5], unique[5:25]
    near = " ".join(words_of(without[0].text) + ["more"])
    copies = [with_id[0].asDict() | {"doc_id": None}, without[1].asDict() | {"doc_id": None}, without[0].asDict() | {"doc_id": None, "text": near}]
    given = [r.asDict() for r in with_id] + [r.asDict() | {"doc_id": None} for r in without] + copies
    docs = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in given], schema).repartition(3)
    after = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(r.doc_id for r in with_id)
    texts = [r.text for r in after if r.doc_id is None]
    assert len(texts) == len(without) and (without[0].text in texts) + (near in texts) == 1
    assert {r.text for r in without[1:]} <= set(texts)

    # two sources whose documents have no id and the same sizes: the one under its budget stays whole
    flat = [(None, f"{s} {i} " + "w " * 8, "en", s, 0) for s, n in (("a", 20), ("b", 200)) for i in range(n)]
    mixed = corpus_pipeline.mix_sources(spark, spark.createDataFrame(flat, schema), SF)
    assert {r.text for r in mixed.collect()} >= {r[1] for r in flat if r[3] == "a"}
    tokens = corpus_pipeline.tokenize(spark, mixed, SF).collect()
    assert len(tokens) == mixed.count() and all(r.doc_id is None for r in tokens)


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF)
    assert docs.count() == 0
