import hashlib
import random
import re

from aerotrace.llm.secrets import RULES, Rule, build_index, scan_secrets, trigram_query

ORDER = {r.kind: i for i, r in enumerate(RULES)}


def brute(text):
    text, found = text or "", []
    for r in RULES:
        flags = re.ASCII | (re.IGNORECASE if r.pattern.startswith("(?i)") else 0)
        for m in re.finditer(r.pattern.removeprefix("(?i)"), text, flags):
            if len(m[r.group]) >= r.least:
                found.append((m.start(), ORDER[r.kind], f"{r.kind}:{m.start()}:{m.end()}", r.base))
    found.sort()
    base = ",".join(x[2] for x in found if x[3])
    count = lambda k: sum(x[2].startswith(k + ":") for x in found)
    return (count("assign"), count("access"), count("hex"), hashlib.sha256(base.encode()).hexdigest(), ",".join(x[2] for x in found))


def texts():
    rng = random.Random(6)
    parts = ["password", "PassWd", "secret", "token", "API_KEY", "apikey", ":", "=", '"', "'", " ", "\n", "AKIA", "ABCD1234EFGH5678",
             "deadbeef" * 4, "0123456789abcdef", "ghp_" + "a1B2" * 9, "xoxb-1234567890-abc", "AIza" + "x" * 35, "é", "\U0001f600", "word",
             "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM", "-----BEGIN RSA PRIVATE KEY-----", "abc.def/12+=", "token=token : abcdefghij"]
    return [None, "", "secret=short", "token=token : abcdefghij", "password = 'correcthorse'", "AKIAAKIA" + "A1" * 8,
            "x" * 3000 + "secret: abcdefgh" + "f" * 40] + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(400)]


def test_scan_equals_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in scan_secrets(docs).collect()}
    want = {i: brute(t) for i, t in enumerate(texts())}
    assert got == want
    assert len({x.split(":")[0] for v in want.values() for x in v[4].split(",")} - {""}) == len(RULES)


def test_queries_hold_for_every_match():
    for r in RULES:
        query = trigram_query(r.pattern)
        for t in texts():
            flags = re.ASCII | (re.IGNORECASE if r.pattern.startswith("(?i)") else 0)
            for m in re.finditer(r.pattern.removeprefix("(?i)"), t or "", flags):
                low = m[0].lower()
                assert all(any(all(g in low for g in alt) for alt in clause) for clause in query)
    assert trigram_query("[0-9a-f]{32,}") == [] and trigram_query("ab.c") == []
    assert trigram_query("abcd[0-9]+efg") == [[frozenset({"abc", "bcd"})], [frozenset({"efg"})]]


def test_index_is_complete_and_rows_stay(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(1, "ABCabc"), (2, "xbcd"), (3, None)], "k long, t string")
    got = sorted(tuple(r) for r in build_index(docs, ["abc", "bcd", "zzz"], "k", "t").collect())
    assert got == [("abc", 1), ("bcd", 2)]
    assert scan_secrets(no_docs).count() == 0
    assert scan_secrets(odd_docs).count() == odd_docs.count()
    only = (Rule("hex", "[0-9a-f]{32,}", 0, 32, True),)  # no indexed rule at all
    assert scan_secrets(odd_docs, rules=only).count() == odd_docs.count()
