import random
import zlib

import numpy as np

from aerotrace.llm import tokens


def odd_strings(rng, n):
    alphabet = list(" \n\t'!?.sstrevmldLLé123½²　") + ["'s", "'re", "'ll", "  ", "\r\n", "日", "λ", "\U0001f600", "​",
                                                      "<|endoftext|>", "\x85", "\x1c", "\0"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30))) for _ in range(n)]


def library(texts):
    tok = tokens.encoder(tokens.vocabulary_path()).tokenizer
    return [tok.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_encoder_equals_the_library():
    texts = odd_strings(random.Random(1), 1500) + ["", "plain words again and again", "plain words " * 300]
    enc = tokens.Encoder(tokens.vocabulary_path(), cache=64)  # a small cache is cleared on the way
    for part in (texts[:700], texts[700:], ["", ""]):
        ids, counts = enc.encode(part, 2)
        ends = np.cumsum(counts)
        got = [ids[a:b].tolist() for a, b in zip(ends - counts, ends)]
        assert got == [x + [2] for x in library(part)]
    assert enc.encode(["", "x"])[1].tolist() == [0, 1]


def test_pack_bits_round_trip():
    for bits in (1, 5, 15, 16, 17, 20, 31):
        for n in (0, 1, 63, 64, 5000):
            ids = np.random.default_rng(bits).integers(0, 2**bits, n, dtype=np.uint32)
            packed = tokens.pack_bits(ids, bits)
            assert len(packed) == -(-n // 64) * 8 * bits
            assert (tokens.unpack_bits(packed, bits, n) == ids).all()


def test_files_hold_what_the_library_gives(spark, odd_docs, monkeypatch, tmp_path):
    monkeypatch.setattr(tokens, "SEGMENT", 2000)
    rng = random.Random(2)
    rows = [(i * 7 % 101, t) for i, t in enumerate(odd_strings(rng, 100))] + [(500, "word " * 9000), (501, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokens.token_table(docs).collect()}
    want, at = {}, 0
    for (i, t), ids in zip(sorted(rows), library([t for _, t in sorted(rows)])):
        ids = np.array(ids + [2], dtype="<u4")
        want[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == want

    target = str(tmp_path / "files")
    tokens.write_token_files(docs, target)
    row = max(spark.read.parquet(target).collect(), key=lambda r: r["n_ids"])
    whole = tokens.unpack_bits(bytes(row["payload"]), row["bits"], row["n_ids"])
    blocks = [tokens.read_block(row, b) for b in range(len(row["block_offsets"]))]
    assert len(blocks) > 1 and (np.concatenate(blocks) == whole).all()


def test_files_odd_rows(odd_docs, no_docs):
    assert tokens.token_table(no_docs).count() == 0
    rows = tokens.token_table(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])[:-1]]).tolist()
    ids = [r.doc_id for r in rows]
    assert ids[-1] is None and ids[:-1] == sorted(ids[:-1])
    assert [r.n_tokens for r in rows[:3]] == [1, 1, rows[2].n_tokens]


def test_histogram_answers_equal_brute_force(spark, odd_docs, no_docs):
    assert tokens.length_histogram(no_docs).count() == 0
    assert [tuple(r) for r in tokens.context_totals(tokens.length_histogram(no_docs), [5]).collect()] == [(5, 0, 0)]
    lengths = sorted(len(x) for x in library([r.text for r in odd_docs.collect()]))
    histogram = tokens.length_histogram(odd_docs)
    for r in histogram.collect():
        longer = [x for x in lengths if x >= r.n_tokens]
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (lengths.count(r.n_tokens), len(longer), sum(longer))
        assert r.truncated_total == sum(min(x, r.n_tokens) for x in lengths)
        assert abs(r.share_below - (len(lengths) - len(longer)) / len(lengths)) < 1e-12
    assert histogram.count() == len(set(lengths))
    limits = [0, 1, 2, 3, 50, 1000, 10**6]
    got = {r.context: (r.docs_over, r.truncated_total) for r in tokens.context_totals(histogram, limits).collect()}
    assert got == {c: (sum(x > c for x in lengths), sum(min(x, c) for x in lengths)) for c in limits}
