import hashlib
import random

import numpy as np

from pyspark.sql import functions as F

from aerotrace.llm import substrings
from aerotrace.llm.substrings import merge_ranges, remove_repeats


def brute(docs, length):
    first = {}
    for i, raw in docs:
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            first[w] = min(i, first.get(w, i))
    out = {}
    for i, raw in docs:
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (gone[p - 1] if p else 0) for p, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(rng):
    """Copies, shared passages, chains of overlaps, periodic and short texts."""
    words = ["alpha", "béta", "gamma", "d", "eps", "\U0001f600", "zeta", "the", "of"]
    say = lambda n: " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))
    passages = [say(rng.randrange(5, 30)) for _ in range(6)]
    texts = ["", "a" * 49, "a" * 50, "a" * 300, "ab" * 200, "b" + "ab" * 90]
    for _ in range(60):
        parts = [say(rng.randrange(0, 20))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts.append(rng.choice([p, p[a:], p[:a], p[a:a + 55]]))
            parts.append(say(rng.randrange(0, 6)))
        texts.append(" ".join(parts))
    texts += [rng.choice(texts) for _ in range(10)]
    rng.shuffle(texts)
    return list(enumerate(texts, 3))


def test_removed_bytes_equal_brute_force(spark):
    for seed in (1, 2):
        docs = corpus(random.Random(seed))
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df).collect()}
        want = brute([(i, t.encode()) for i, t in docs], 50)
        assert got == want
        assert sum(x[1] for x in want.values()) > 2000


def test_a_shared_passage_is_cut_into_bounded_groups(spark, monkeypatch):
    """Every document has its own bytes at the edges of one shared passage."""
    rng = random.Random(5)
    say = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage = say(180)
    docs = [(i, say(rng.randrange(20, 60)) + passage + say(rng.randrange(20, 60))) for i in range(1500)]
    docs += [(2000 + i, t) for i, t in corpus(rng)]
    seen, settle = [], substrings._ranges

    def watch(surroundings, *args):
        seen.append(surroundings.where("grp >= 0").groupBy("grp", "salt").agg(F.sum(F.octet_length("ids") / 8).alias("n")).agg(F.max("n")).first()[0])
        return settle(surroundings, *args)

    monkeypatch.setattr(substrings, "_ranges", watch)
    monkeypatch.setattr(substrings, "HOT_ENTRIES", 50, raising=False)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df).collect()}
    assert got == brute([(i, t.encode()) for i, t in docs], 50)
    assert seen[0] <= 500


def test_odd_rows(odd_docs, no_docs):
    assert remove_repeats(no_docs).count() == 0
    rows = remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [by_id[i][0].n_bytes for i in (0, 1, 3)] == [0, 0, 4]
    assert by_id[None][0].n_removed == 0
    assert [by_id[i][0].n_removed > 0 for i in (100, 101, 102, 103)] == [False, True, True, True]
    assert len(by_id[103]) == 2


def test_merge_ranges():
    assert merge_ranges(np.array([[5, 9], [0, 3], [3, 4], [8, 12], [20, 21]])).tolist() == [[0, 4], [5, 12], [20, 21]]


def test_peak_of_a_slice_is_a_few_times_its_bytes():
    """Hashes and masks are made block by block; the runs stay the same."""
    import tracemalloc
    rng = np.random.default_rng(3)
    n = 1 << 20
    data = rng.integers(97, 105, n).astype(np.uint8)
    offsets = np.sort(np.concatenate([[0, n, n], rng.integers(0, n, 700), [5, 5, 30]]))
    tracemalloc.start()
    text, first, last, bucket = substrings.anchor_runs(data, offsets, 50, 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * n
    at = np.concatenate([np.arange(a, b - 49) for a, b in zip(offsets, offsets[1:]) if b - a >= 50])
    assert int((last - first + 1).sum()) == len(at)
    assert (np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)]) == at).all()
    assert (offsets[text] <= first).all() and (last + 50 <= offsets[text + 1]).all()
    sums = substrings.prefix_hash(data)
    for i in (0, len(first) // 2, len(first) - 1):
        grams = np.arange(first[i], first[i] + 31)
        assert bucket[i] == substrings.span_hash(sums, grams, grams + 20).min()
