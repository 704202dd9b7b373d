import hashlib
import zlib

import pytest

SF = "/root/testdata/sf0.001"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i:i + 16])) for i in range(0, len(last), 16)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        a = i - i % 16
        out.append(("".join(level[a:i]), "".join(level[i + 1:a + 16])))
        i //= 16
    return out


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is None, r[0] or 0, h("".join(map(field, r))), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    for n, s in enumerate(sources):
        for i, (_, _, leaf, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            proof = path(trees[s], i) + path(top, n)
            at = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])
                at = h("".join(map(field, (*r[:4], text))))
            for left, right in proof:
                at = h(left + at + right)
            yield (r[0], leaf, trees[s][-1][0], top[-1][0], h("".join(a + b for a, b in proof)), at, at == top[-1][0])


def key(row):
    return (row[0] is None, *[str(x) for x in row])


def check(docs, rows):
    from aerotrace.llm.merkle import manifest_check
    got = [tuple(r) for r in manifest_check(docs).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    return got


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = check(docs, [tuple(r[c] for c in COLUMNS) for r in docs.collect()])
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 16, 17, 256, 257, 300], [4097, 1, 33], [1] * 300, [5, 272]])
def test_tree_shapes(spark, sizes):
    rows, n = [], 0
    for s, size in enumerate(sizes):
        for _ in range(size):
            rows.append((n * 7 % 100003, None if s == 3 else f"s{s}é" if s % 2 else f"S{s}", "en", n, f"Text {n}"))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    check(docs, rows)


def test_odd_rows(spark, odd_docs, no_docs):
    from aerotrace.llm.merkle import manifest_check
    check(odd_docs, [tuple(r[c] for c in COLUMNS) for r in odd_docs.collect()])
    clash = odd_docs.withColumns({c: odd_docs.doc_id for c in ("grp", "idx", "n", "digest", "sub", "key", "leaf", "changed")})
    check(clash, [tuple(r[c] for c in COLUMNS) for r in odd_docs.collect()])
    assert manifest_check(no_docs).count() == 0


def test_manifest_of_other_columns(spark):
    from aerotrace.llm.merkle import Manifest, fold
    from pyspark.sql import functions as F
    table = spark.createDataFrame([(i, f"g{i % 3}", i * i) for i in range(100)], "k int, g string, v int")
    m = Manifest(table, ["k", "v"], "g", "k", {"k": F.col("k")})
    rows = m.proofs().select("k", fold(F.col("leaf"), F.col("proof")).alias("root")).collect()
    assert len(rows) == 100 and {r.root for r in rows} == {m.root}
