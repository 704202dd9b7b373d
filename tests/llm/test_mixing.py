import random

from conftest_llm import words_of

from aerotrace.llm.mixing import mix, mixed_documents, source_targets

WEIGHTS = (5, 2, 1)


def brute_targets(sizes):
    """Share by weight; sources above 3 times their size stop there, again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= 3 * sizes[s]]
        if not over:
            return {**stopped, **share}
        stopped |= {s: 3 * sizes[s] for s in over}
        if len(stopped) == len(names):
            return stopped


def test_targets_equal_repeated_sharing(spark):
    rng = random.Random(4)
    for n in (1, 2, 3, 7, 12):
        sizes = {f"s{i:02d}": rng.choice([0, 1, 10, 100, 5000]) for i in range(n)} | ({None: 77} if n % 2 else {})
        df = spark.createDataFrame([(s, z) for s, z in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in source_targets(df).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want), (got, want)


def corpus(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", "d", None]), " ".join(["w"] * rng.randrange(0, 60))) for i in range(400)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6)


def test_budgets_are_met_and_repeat(spark):
    rows, docs = corpus(spark)
    got = mix(docs).collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(words_of(t))
    targets = brute_targets(sizes)
    source = {i: s for i, s, _ in rows}
    taken = {}
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]] and 0 <= r.taken <= 3 * r.size
        assert abs(r.target - targets[source[r.doc_id]]) < 1e-6
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert all(abs(taken[s] - targets[s]) <= 0.5 + 1e-6 for s in sizes)
    key = lambda rows: sorted((r.doc_id, r.taken) for r in rows)
    assert key(got) == key(mix(docs.repartition(3)).collect())


def test_mixed_documents_hold_the_words_taken(spark):
    rows, docs = corpus(spark)
    taken = {r.doc_id: r.taken for r in mix(docs).collect()}
    words = {}
    for r in mixed_documents(docs).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(words_of(r.text))
    assert {i: n for i, n in words.items() if n} == {i: n for i, n in taken.items() if n}


def test_odd_rows(odd_docs, no_docs):
    assert mix(no_docs).count() == 0 and mixed_documents(no_docs).count() == 0
    got = mix(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert mixed_documents(odd_docs).columns == odd_docs.columns


def test_rows_without_an_id_are_taken_at_random(spark):
    """Whether such a row is taken does not follow its size."""
    rng = random.Random(2)
    rows = [(None, "a", f"t{i} " + "w " * rng.randrange(1, 60)) for i in range(300)] + [(1, "b", "word " * 6000)]
    got = mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), weights=(2, 7)).collect()
    mine = [r for r in got if r.doc_id is None]
    whole, left = [[r.size for r in mine if (r.taken >= r.size) == x] for x in (True, False)]
    assert len(whole) > 50 and len(left) > 50 and abs(sum(whole) / len(whole) - sum(left) / len(left)) < 10


def test_cut_texts_keep_their_white_space_and_other_columns(spark):
    rows = [(i, "a", f" one\t\ttwo{i}\n three  four ", i, "k", "z") for i in range(9)] + [(99, "b", "x " * 400, 7, "k", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, _key long, _size string, _first string")
    out = mixed_documents(docs, weights=(1, 30)).collect()
    text = {r[0]: r[2] for r in rows}
    assert all(r._key == (7 if r.doc_id == 99 else r.doc_id) and (r._size, r._first) == ("k", "z") for r in out)
    cut = [r for r in out if r.text != text[r.doc_id]]
    assert cut and all(text[r.doc_id].startswith(r.text) and r.text[-1].strip() for r in cut)
