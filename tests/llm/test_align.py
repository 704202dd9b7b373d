import hashlib
from collections import Counter, defaultdict

import pytest

SF = "/root/testdata/sf0.001"
ODD = ["x", " ", "  two  blanks ", "line\n\n\ttab", "emoji \U0001f600\U0001f600 ▁ mark", "▁", "mid ▁dle", "<s>a</s> <unk>",
       "<|endoftext|> here <|endoftext|>", "nul\0byte", "é́ ﬁ ｱ \xa0 　", "=" * 300 + " " * 40 + "a" * 200, "<0x41> <0x0A>",
       "日本語のテキスト", "don't we'll", "a\r\nb "]


def brute(rows):
    """Straight from the definition, with whole texts given to both libraries."""
    import public_tokenizers as P
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    from aerotrace.llm.align import byte_alphabet
    ta = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ta.encode_special_tokens = True
    tb = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    back = byte_alphabet()
    held, docs = [], defaultdict(int)
    for doc, text in rows:
        groups = []
        if text:
            a = ta.encode(" " + text, add_special_tokens=False).ids
            b = tb.encode(text, num_threads=1)
            bytes_a = [bytes(back[c] for c in ta.id_to_token(i)) for i in a]
            bytes_b = [bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i) else tb.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends = [{}, {}]
                for side, parts in enumerate((bytes_a, bytes_b)):
                    at = 0
                    for n, part in enumerate(parts):
                        at += len(part)
                        ends[side][at] = n + 1
                i = j = 0
                for end in sorted(ends[0].keys() & ends[1].keys()):
                    groups.append((a[i:ends[0][end]], b[j:ends[1][end]]))
                    i, j = ends[0][end], ends[1][end]
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        for pair in links:
            docs[pair] += 1
        held.append((doc, groups, links))
    best = defaultdict(int)
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    for doc, groups, links in held:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        yield (doc, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(links.values()),
               sum(n for p, n in links.items() if docs[p] == best[p[0]]), sum(n * docs[p] for p, n in links.items()),
               hashlib.sha256(text.encode()).hexdigest() if groups else "")


def got(df):
    return sorted(((r[0], r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()),
                  key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("slice_pairs", [1 << 18, 300])
def test_equals_brute_force_on_documents(spark, monkeypatch, slice_pairs):
    from aerotrace.llm import align
    from aerotrace.llm.align import op11_tokenizer_alignment
    monkeypatch.setattr(align, "SLICE_PAIRS", slice_pairs)  # goes to the tasks with the function that reads it
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(op11_tokenizer_alignment(spark, SF)) == sorted(brute(rows))


@pytest.mark.parametrize("plain", [0, 2, 1 << 40])
def test_links_of_large_groups(monkeypatch, plain):
    from aerotrace.llm import align
    monkeypatch.setattr(align, "PLAIN_PAIRS", plain)
    both = align.sides(align.vocabulary_path("byte_bpe_50k.json"), align.vocabulary_path("piece_bpe_32k.model"))
    x = align.Aligned(both, ODD)
    want = {}
    for g in range(x.n_groups):
        a, b = (x.ids[s][x.group[s] == g].tolist() for s in (0, 1))
        for i in a:
            for j in b:
                key = (int(x.doc[0][x.group[0] == g][0]), i * 32000 + j)
                want[key] = want.get(key, 0) + 1
    assert {(d, c): t for d, c, t in zip(*(v.tolist() for v in x.linked(32000)))} == want


def test_odd_rows(spark, odd_docs, no_docs):
    from aerotrace.llm import align
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(1000 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(brute(rows), key=lambda r: (r[0] is None, r))
    assert got(align.alignment(docs)) == want
    assert any(r[1] == 0 for r in want if r[0] and r[0] >= 1000) and all(r[1] for r in want if r[0] in (1008, 1009, 1011))
    assert got(align.alignment(odd_docs)) == sorted(brute([(r.doc_id, r.text) for r in odd_docs.collect()]), key=lambda r: (r[0] is None, r))
    assert align.alignment(no_docs).count() == 0


def test_groups(spark):
    from aerotrace.llm.align import sides, token_groups, vocabulary_path
    a, b = sides(vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))
    rows = [(i, t) for i, t in enumerate(ODD)]
    out = token_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    for i, t in rows:
        mine = sorted((r.n, r.start, r.end, r.a_ids, r.b_ids) for r in out if r.doc_id == i)
        if not mine:
            assert "▁" in t
            continue
        raw, at = (" " + t).encode(), 0
        for n, (k, start, end, ia, ib) in enumerate(mine):
            assert k == n and start == at
            assert b"".join(a.tokens.bytes[x] for x in ia) == b"".join(b.tokens.bytes[x] for x in ib) == raw[start:end]
            at = end
        assert at == len(raw)


def test_overlaps_and_pairs_with_one_key(monkeypatch):
    """Matches stay in their text, also of tokens without bytes at a text's
    end, with (document, offset) as one key; pairs are the same whether
    document and code fit one sort key or not."""
    import numpy as np
    import pandas as pd

    from aerotrace.llm import align
    x = align.Aligned.__new__(align.Aligned)
    x.n = 9
    x.doc = [np.array([0, 0, 0, 2, 2]), np.array([0, 0, 2, 2, 2])]
    size = [np.array([2, 3, 0, 4, 0]), np.array([4, 1, 1, 2, 1])]
    x.start = [np.cumsum(n) - n for n in size]
    frames = [pd.DataFrame({"start": s, "doc": d, c: np.arange(len(s))}) for s, d, c in zip(x.start, x.doc, "ab")]
    one = pd.merge_asof(frames[0], frames[1], on="start", by="doc")
    two = pd.merge_asof(frames[1], frames[0], on="start", by="doc")
    keyed = []
    plain = pd.merge_asof
    monkeypatch.setattr(pd, "merge_asof", lambda *a, **k: keyed.append("by" in k) or plain(*a, **k))
    a, b = x.overlaps()
    assert a.tolist() == [*one["a"], *two["a"]] and b.tolist() == [*one["b"], *two["b"]]
    assert keyed == [False, False]
    both = align.sides(align.vocabulary_path(align.VOCABULARY_A), align.vocabulary_path(align.VOCABULARY_B))
    x = align.Aligned(both, [*ODD, "the same the same the same", "", "the same"])
    got = []
    for width in (len(both[1].size), 1 << 45):
        doc, code, times = x.linked(width)
        got.append(list(zip(doc.tolist(), (code // width).tolist(), (code % width).tolist(), times.tolist())))
    assert got[0] == got[1] and len(got[0]) == len({r[:3] for r in got[0]})


def test_staged_rows_are_documents(spark, monkeypatch):
    """A staged row holds one document's pairs however many its slice has, no
    aggregate collects a slice, and wide rows go in small row groups."""
    from pathlib import Path

    import pyarrow.parquet as pq

    from aerotrace.llm import align
    rows = [(i, f"{ODD[i % len(ODD)]} {i} " + "some more text " * (i % 7)) for i in range(400)] + [(None, None), (3, "x")]
    staged = []

    def keep(df, *args, **options):
        staged.append(real(df, *args, **options))
        return staged[-1]

    real = align.stage_table
    monkeypatch.setattr(align, "stage_table", keep)
    monkeypatch.setattr(align, "GROUP_BYTES", 1 << 12, raising=False)
    out = align.alignment(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert got(out) == sorted(brute(rows), key=lambda r: (r[0] is None, r))
    assert "ObjectHashAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    held = staged[0].collect()
    assert len(held) == len(rows) and len({(r.part, r.slice) for r in held}) == 1
    assert sum(len(r.pair_a) > 0 for r in held) == 1
    assert all(len(r.place) in (r.held, 2 * r.held) and len(r.times) in (r.held, 2 * r.held) for r in held)
    files = Path(staged[0]._staged_path.removeprefix("file:")).glob("*.parquet")
    assert max(pq.ParquetFile(f).num_row_groups for f in files) > 1


@pytest.mark.parametrize("most", [0, 1, 255, 256, 65535, 65536, 1 << 40])
def test_packed_numbers(most):
    import numpy as np
    import pyarrow as pa

    from aerotrace.llm import align
    values, per_row = np.array([most, 0, most // 2, 1, most]), np.array([0, 2, 0, 3, 0])
    column = pa.chunked_array([align._packed(values, per_row)])
    assert align._unpacked(column, 5).tolist() == values.tolist()
    assert [len(b) > 0 for b in column.to_pylist()] == [n > 0 for n in per_row]
    assert align._unpacked(pa.chunked_array([align._packed(values[:0], np.zeros(3, int))]), 0).tolist() == []
