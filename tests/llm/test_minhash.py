import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

from aerotrace.llm.components import connected_components
from aerotrace.llm.minhash import SIZE, near_duplicates, super_minhash
from conftest_llm import brute_components, shingle_set


def mutate(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"z{rng.random()}"
    return words


def corpus():
    """Families whose members differ by a few words, chains, exact copies."""
    rng = random.Random(5)
    texts = []
    for _ in range(25):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.randrange(30, 200))]
        texts.append(base)
        for _ in range(rng.randrange(0, 12)):
            base = base if rng.random() < 0.6 else texts[-1]
            texts.append(mutate(rng, base, rng.randrange(0, 6)))
    texts = [" ".join(t).upper() if rng.random() < 0.1 else " ".join(t) for t in texts]
    rng.shuffle(texts)
    return texts


def test_super_minhash_estimates_similarity_and_ignores_order():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 900, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 100, dtype=np.uint64)])
    one = rng.integers(0, 2**63, 1, dtype=np.uint64)
    sig = super_minhash(np.concatenate([a, b, a[::-1], one]), np.array([0, 900, 1800, 2700, 2701, 2701]), SIZE)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.15
    assert (sig[0] == sig[2]).all()
    assert np.isfinite(sig[:4]).all() and np.isinf(sig[4]).all()
    assert sorted(sig[3].astype(int)) == list(range(SIZE))  # one element fills every position once


def test_near_duplicates_equal_brute_force(spark):
    for k in (4, 5):
        texts = corpus()
        docs = spark.createDataFrame([(i * 3 + 1, t) for i, t in enumerate(texts)], "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, k=k).collect()}
        sets = {i * 3 + 1: shingle_set(t, k) for i, t in enumerate(texts)}
        comp = brute_components(sets)
        assert got == {d: (len(s), comp[d], comp[d] == d) for d, s in sets.items()}


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    assert near_duplicates(no_docs).count() == 0
    rows = near_duplicates(odd_docs, k=4).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].n_shingles for i in (0, 1, 2, 3, 4)] == [0, 0, 0, 1, 1]
    assert all(by_id[i].kept and by_id[i].component_id == i for i in (0, 1, 2, 3, 4, 7, 9))
    assert {by_id[i].component_id for i in range(100, 104)} == {100}
    assert by_id[None].component_id is None and not by_id[None].kept
    assert sum(r.doc_id == 103 for r in rows) == 2


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3), (500, 400)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == ({i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 160)} | {400: 400, 500: 400})
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_are_split_at_ascii_white_space_only():
    assert re.findall(r"[^\x20\x09-\x0D]+", "a b\x0bc") == ["a b", "c"]
    assert shingle_set("a b\x0bc", 4) == {("a b", "c")}


def test_ids_that_name_several_texts(spark):
    """Every text is compared, whatever id it shares; ids 1 and 2 are near
    copies of the two texts of id 5."""
    rng = random.Random(8)
    a, b = ([f"{c}{rng.randrange(10**6)}" for _ in range(150)] for c in "ab")
    near = [" ".join(mutate(rng, t, 2)) for t in (a, b)]
    a, b = " ".join(a), " ".join(b)
    rows = [(1, near[0]), (2, near[1]), (5, a), (5, b), (5, b.upper()), (9, "words of its own " * 30)]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3), k=4).collect())
    assert got == [(1, 1, True), (2, 2, True), (5, 1, False), (5, 2, False), (5, 2, False), (9, 9, True)]


def test_one_per_group_keeps_a_defined_row(spark, odd_docs, no_docs):
    from aerotrace.llm.minhash import one_per_group
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    near = " ".join(mutate(rng, base, 2))
    base = " ".join(base)
    other = "another text without an id " * 8
    rows = [(7, base, "s1", 3, "b"), (7, base, "s0", 3, "a"), (7, base, None, 4, "c"), (3, near, "s9", 1, "d"), (None, base, "s", 1, "e"),
            (None, other, "y", 2, "f"), (None, other, "x", 2, "g"), (8, "", "s", 1, "h"), (8, "", "s", 1, "h"), (None, None, "s", 1, "i"),
            (11, other + "tail", "z", 0, "j")]
    schema = "doc_id long, text string, source string, _id long, t1 string"
    for parts in (1, 5):
        got = one_per_group(spark.createDataFrame(rows, schema).repartition(parts), k=5)
        assert got.columns == ["doc_id", "text", "source", "_id", "t1"]
        assert sorted(r.t1 for r in got.collect()) == ["d", "h", "h", "i", "j"]
    alone = [r for r in rows if r[4] not in "dj"]
    got = one_per_group(spark.createDataFrame(alone, schema).repartition(4), k=5).collect()
    assert sorted((r.t1, r.source or "") for r in got) == [("c", ""), ("g", "x"), ("h", "s"), ("h", "s"), ("i", "s")]
    assert one_per_group(no_docs).count() == 0
    kept = one_per_group(odd_docs, k=5).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None and r.doc_id >= 100) == [100]


def test_steps_on_few_rows_take_few_tasks(spark, monkeypatch):
    """However many partitions a shuffle has; the results stay those of brute
    force, and no pair or node comes out twice."""
    from aerotrace.llm import components, minhash
    files, repeats, stage = {}, {}, minhash.stage_table

    def seen(df, name, *more):
        table = stage(df, name, *more)
        files[name] = max(files.get(name, 0), len(table.inputFiles()))
        if name in ("minhash-pairs", "cc-labels", "minhash-members"):
            keys = {"cc-labels": ["node"], "minhash-members": ["bucket", "node"]}.get(name, table.columns)
            repeats[name] = repeats.get(name, 0) + table.count() - table.select(keys).distinct().count()
        return table

    monkeypatch.setattr(minhash, "stage_table", seen)
    monkeypatch.setattr(components, "stage_table", seen)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        texts = corpus()
        docs = spark.createDataFrame([(i * 3 + 1, t) for i, t in enumerate(texts)], "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in near_duplicates(docs, k=4).collect()}
        chain = spark.createDataFrame([(i, i + 1) for i in range(1, 60)], "a long, b long")
        labels = components.labels_of_others(chain)
        assert sorted(map(tuple, labels.collect())) == [(i, 1) for i in range(2, 61)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == brute_components({i * 3 + 1: shingle_set(t, 4) for i, t in enumerate(texts)})
    assert repeats == {"minhash-pairs": 0, "cc-labels": 0, "minhash-members": 0}
    few = {name: n for name, n in files.items() if name not in ("minhash", "minhash-pairs", "cc-links")}
    assert max(few.values()) <= 3, few


class Taken:
    """Stands for a table: keeps the function that its batches would go through."""

    def mapInArrow(self, function, schema):
        self.function = function
        return self


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_large_sets_are_taken_in_parts(monkeypatch):
    """A set of any size takes bounded memory and keeps its signature."""
    from aerotrace.llm import minhash
    rng = np.random.default_rng(5)
    counts = np.array([0, 70, 3000, 0, 1, 2, 40, 900, 0])
    offsets = np.concatenate([[0], np.cumsum(counts)])
    values = rng.integers(0, 2**63, offsets[-1], dtype=np.uint64)
    for m in (96, 512):
        # a set's signature is the least of those of its elements
        alone = minhash.super_minhash(values, np.arange(len(values) + 1), m)
        want = np.array([alone[a:b].min(axis=0, initial=np.inf) for a, b in zip(offsets[:-1], offsets[1:])])
        for size in (minhash.ORDER_BYTES, 500 * m, 60 * m):
            monkeypatch.setattr(minhash, "ORDER_BYTES", size)
            assert np.array_equal(minhash.super_minhash(values, offsets, m), want)
        monkeypatch.undo()
    large = rng.integers(0, 2**63, 200_000, dtype=np.uint64)
    assert peak_mb(lambda: minhash.super_minhash(large, np.array([0, len(large)]), 512)) < 48


def test_steps_on_texts_take_little_memory():
    """What a Python worker took it may keep for as long as it lives."""
    from aerotrace.llm.minhash import long_signatures, shingle_sets, signatures
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(9000)}" for _ in range(350)) for _ in range(1500)] + ["a b"] * 6000
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids] * 4 + [pa.array(texts)], names=["id", "t1", "t2", "node", "text"])
    sets = []
    runs = {"signatures": lambda: [len(x) for x in signatures(Taken(), 5).function([batch])],
            "sets": lambda: sets.extend(shingle_sets(Taken(), 5).function([batch]))}
    peaks = {name: peak_mb(run) for name, run in runs.items()}
    lists = pa.Table.from_batches(sets).combine_chunks().to_batches()[0]
    assert lists.column("node").equals(ids)
    lists = pa.RecordBatch.from_arrays([*lists.columns, lists.column("node")], names=["node", "shingles", "all"])
    rows = []
    peaks["long"] = peak_mb(lambda: rows.extend(len(x) for x in long_signatures(Taken()).function([lists])))
    assert sum(rows) == len(texts)
    assert max(peaks.values()) < 48, peaks
