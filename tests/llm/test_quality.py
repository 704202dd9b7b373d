import random
import re
from collections import Counter

from conftest_llm import words_of

from aerotrace.llm.quality import passing, quality


def brute(text):
    text = text or ""
    w = words_of(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words_of(line):
            dup += line in seen
            seen.add(line)
    n, rep = len(w), len(covered)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, rep, n < 50 or 100 * rep > 50 * n)


def texts():
    rng = random.Random(3)
    out = [None, "", " \n ", "a a a", "a a a a", "a b a b a b", "x y z x y", "z\n\nz\n z\nz", "#* |<>$%&", "é\U0001f600 ü\x0bß"]
    for _ in range(150):
        words = [rng.choice(["the", "of", "and", "le", "A", "#x#", "wörd", "b", "c", "d"]) + rng.choice(["", str(rng.randrange(6))])
                 for _ in range(rng.randrange(0, 130))]
        out.append("".join(x + rng.choice([" ", "\n", "  ", "\t", " "]) for x in words))
    out += ["the cat sat on a mat \n" * 400, " ".join(f"word{i} of" for i in range(9000)), "THE END OF IT " + "LOUD WORDS! " * 30]
    return out


def test_counts_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in quality(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts())}


def test_rules_and_filter(spark, odd_docs, no_docs):
    rng = random.Random(8)
    prose = " ".join(rng.choice(["the", "of", "and", "in"]) + f" thing{rng.randrange(9999)}" for _ in range(80))
    rows = [(1, prose), (2, prose.upper()), (3, " | ".join(f"cell{i}" for i in range(90))), (4, prose.replace("thing", "## th")),
            (5, " ".join(f"nostop{i}" for i in range(90))), (6, "\n".join([prose[:500]] + ["menu"] * 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in quality(docs).collect()}
    assert got[1].kept and not got[1].failed_rules
    assert [got[i].kept for i in range(2, 7)] == [False] * 5
    assert "upper_case" in got[2].failed_rules and "symbols" in got[3].failed_rules and "symbols" in got[4].failed_rules
    assert "stop_words" in got[5].failed_rules and (got[6].base_failed or "duplicate_lines" in got[6].failed_rules)
    assert [r.doc_id for r in passing(docs).collect()] == [1] and passing(docs).columns == docs.columns
    assert quality(no_docs).count() == 0 and quality(odd_docs).count() == odd_docs.count()
    assert passing(odd_docs).columns == odd_docs.columns
