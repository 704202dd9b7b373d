import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
from conftest_llm import lower_ascii, words_of

from aerotrace.llm import decontam


def brute(docs, items):
    def grams(w, k):
        return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
    out = {}
    for d, text in docs:
        w = words_of(lower_ascii(text))
        for i, item in items:
            x = words_of(lower_ascii(item))
            k = min(5, len(x))
            if not x or len(w) < k:
                continue
            a = Counter(grams(x, k))
            size = min(len(x), len(w))
            best = None
            for s in range(len(w) - size + 1):
                b = Counter(grams(w[s:s + size], k))
                shared = sum((a & b).values())
                union = sum(a.values()) + sum(b.values()) - shared
                if 100 * shared >= 80 * union and (best is None or shared / union > best[1]):
                    best = (s, shared / union)
            if best:
                out[(d, i)] = best
    return out


def corpus():
    rng = random.Random(11)
    say = lambda n: [rng.choice(["the", "of", "a", "in"]) if rng.random() < 0.4 else f"w{rng.randrange(3000)}" for _ in range(n)]
    items = [(i, " ".join(say(rng.choice([1, 3, 5, 6, 20, 40, 41, 120])))) for i in range(40)]
    items += [(90, items[0][1]), (91, "same same same same same same same same same same"), (92, ""), (93, None)]
    docs = []
    for d in range(120):
        body = say(rng.randrange(0, 150))
        for _ in range(rng.randrange(0, 3)):
            x = words_of(rng.choice(items)[1])
            if len(x) > 60 and rng.random() < 0.5:
                x = list(x)
                x[rng.randrange(len(x))] = "changed"
            if len(x) > 30 and rng.random() < 0.3:
                x = x[2:]
            at = rng.randrange(len(body) + 1)
            body[at:at] = [y.upper() if rng.random() < 0.3 else y for y in x]
        docs.append((d, " ".join(body)))
    docs += [(200, "same " * 30), (201, None), (202, ""), (203, words_of(items[7][1])[0])]
    return docs, items


def test_matches_equal_brute_force(spark):
    docs, items = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.first_word, r.similarity) for r in decontam.contamination(df, bench).collect()}
    want = brute(docs, items)
    assert got.keys() == want.keys() and len(want) > 60
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-12 for k in want)
    hit = {d for d, _ in want}
    assert {r.doc_id for r in decontam.clean_documents(df, bench).collect()} == {d for d, _ in docs} - hit


def test_item_blocks_do_not_change_matches(spark, monkeypatch):
    docs, items = corpus()
    df = spark.createDataFrame(docs[:40], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda: sorted(tuple(r) for r in decontam.contamination(df, bench).collect())
    whole = rows()
    monkeypatch.setattr(decontam, "ITEM_BYTES", 2000)
    assert rows() == whole and whole


def test_multi_index_guarantees_the_radius():
    rng = np.random.default_rng(1)
    shingles = [rng.integers(0, 2**63, 30, dtype=np.uint64) for _ in range(200)]
    group = decontam.Group(30, list(range(200)), shingles)
    flips = np.zeros((200, 64), dtype=np.uint8)
    for row in flips:
        row[rng.choice(64, decontam.RADIUS, replace=False)] = 1
    near = group.prints ^ np.packbits(flips, axis=1)
    found = set(group.within_radius(near))
    assert all((i, i) in found for i in range(200))


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "the same text of a repeated group of documents here", None), (None, "word", "x"), (2, " ", "x")],
                                  "item_id long, text string, doc_id string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(no_docs, bench).count() == 0 and decontam.contamination(odd_docs, none).count() == 0
    rows = decontam.contamination(odd_docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows if r.item_id) == [(100, 1), (101, 1), (102, 1), (103, 1), (103, 1)]
    assert [r.doc_id for r in rows if r.item_id is None] == [3]
    kept = decontam.clean_documents(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 6


def test_repeated_shingles_stay_within_the_radius():
    """Weighted similarity 0.8, with one shingle ten times on each side."""
    rng = np.random.default_rng(7)
    found = 0
    for _ in range(300):
        shared, a, b = rng.integers(0, 2**63, 80, dtype=np.uint64), *rng.integers(0, 2**63, 2, dtype=np.uint64)
        item, window = (np.concatenate([shared, np.full(10, x)]) for x in (a, b))
        rng.shuffle(item)
        group = decontam.Group(90, ["x"], [item])
        found += list(group.within_radius(decontam.fingerprints(window, np.array([0]), 90))) == [(0, 0)]
    assert found >= 297


def test_window_fingerprints_are_those_of_their_features():
    rng = np.random.default_rng(8)
    text = rng.integers(0, 12, 200).astype(np.uint64)
    for size in (1, 2, 7, 40):
        got = decontam.fingerprints(text, np.arange(200 - size + 1), size)
        for a in range(200 - size + 1):
            seen, total = Counter(), np.zeros(64, dtype=np.int64)
            for s in text[a:a + size].tolist():
                feature = (s + seen[s] * 0x9E3779B97F4A7C15) % 2**64
                seen[s] += 1
                bits = int(decontam.mix64(np.array([feature], dtype=np.uint64))[0])
                total += [2 * (bits >> i & 1) - 1 for i in range(64)]
            assert (np.packbits(total > 0) == got[a]).all()


def test_index_of_many_short_items_is_small():
    import pickle
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(50000)}" for _ in range(6)) for _ in range(100000)]
    assert len(pickle.dumps(decontam.Index(list(range(len(texts))), texts))) < 50 << 20


def test_long_texts_are_fingerprinted_in_pieces(monkeypatch):
    """However far apart the matches of a document lie; the matches stay."""
    rng = random.Random(4)
    say = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    items = [say(40), say(40), ["same"] * 30]
    text = " ".join(say(500) + items[0] + say(30_000) + items[2] * 400 + say(9000) + items[1] + items[0] + say(100))
    index = decontam.Index([1, 2, 3], [" ".join(x) for x in items])
    sizes, fingerprints = [], decontam.fingerprints

    def seen(shingles, starts, size):
        sizes.append(len(shingles))
        return fingerprints(shingles, starts, size)

    monkeypatch.setattr(decontam, "fingerprints", seen)
    column = pa.array([text, None, text])
    got = list(index.scan(column))
    assert sorted(x[:4] for x in got) == [(r, i, a, n) for r in (0, 2) for i, a, n in ((1, 500, 40), (2, 51_540, 40), (3, 30_540, 30))]
    assert max(sizes) <= (1 << 13) + 40 and len(sizes) > 4


def test_documents_are_looked_at_in_small_pieces():
    """What a Python worker took it may keep for as long as it lives."""
    rng = random.Random(5)
    item = " ".join(f"w{rng.randrange(5000)}" for _ in range(40))
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(350)) + (" " + item if i % 50 == 0 else "") for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts)], names=["id", "text"])
    index = Held(decontam.Index([1], [item]))
    for run, rows in ((decontam._filter(index, "text"), 1960), (decontam._scanner(index), 40)):
        next(iter(run([batch])))  # tables that are made once
        tracemalloc.start()
        try:
            assert sum(len(x) for x in run([batch])) == rows
            assert tracemalloc.get_traced_memory()[1] < 24 << 20
        finally:
            tracemalloc.stop()


class Held:
    def __init__(self, value):
        self.value = value
