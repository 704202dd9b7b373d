import random
import re

from conftest_llm import lower_ascii

from aerotrace.llm.license_scan import BASE_PHRASES, SENTENCES, scan_licenses


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))


def brute(text):
    w, places, labels = words(text), [], set()
    for phrase, label in BASE_PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def texts():
    rng = random.Random(2)
    bits = ["MIT License", "the mit-license", "Apache\nLicense", "General Public License", "general public", "license", "mit", "é", "x9",
            "word", "apache", "LICENSE!", "\U0001f600"] + [s for s, _ in SENTENCES]
    return [None, "", "!!!", "MIT", "mit license mit license", "mit mit license"] + [
        " ".join(rng.choice(bits) for _ in range(rng.randrange(1, 25))) for _ in range(300)] + ["of the " * 4000 + "mit license"]


def test_base_places_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").repartition(4)
    rows = scan_licenses(docs).collect()
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows}
    assert got == {i: brute(t) for i, t in enumerate(texts())}
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1 for r in rows)
    assert all((r.score == 1) >= (r.n_base > 0) for r in rows)


def test_changed_sentences_are_found_and_others_not(spark):
    sentence = dict((label, s) for s, label in SENTENCES)
    changed = sentence["bsd"].replace("and binary", "and also binary")
    short = " ".join(sentence["mpl"].split()[:5])
    mixed = sentence["isc"].split()
    random.Random(1).shuffle(mixed)
    rows = [(1, "intro words " + sentence["bsd"]), (2, "x " + changed + " y"), (3, short), (4, " ".join(mixed))]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "bsd" and got[1].score == 1.0 and got[1].n_base == 0
    assert got[2].labels == "bsd" and 0.8 <= got[2].score < 1
    assert got[3].labels == "" and got[4].labels == ""


def test_one_word_more_or_less_anywhere(spark):
    rows, want = [], {}
    noise = " this software of the terms and or modify it under a license with or without "
    for s, label in SENTENCES:
        w = s.split()
        for at in range(len(w) + 1):
            rows.append((len(rows), noise * 3 + " ".join([*w[:at], "zz", *w[at:]]) + noise * 3))
            want[len(rows) - 1] = label
            if (len(w) - 3) / (len(w) - 1) >= 0.8:  # a missing word takes two grams with it
                rows.append((len(rows), "x " + " ".join(w[:at] + w[at + 1:]) + " y"))
                want[len(rows) - 1] = label
    isc = "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"
    bsd = "Redistribution and use in any source and binary forms, with or without modification, are permitted"
    rows += [(1000, isc), (1001, bsd), (1002, f"{isc} {isc}\n{bsd}")]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got[i].labels for i in want} == want
    assert got[1000].spans == "isc:0:19" and round(got[1000].score, 4) == round(17 / 19, 4)
    assert got[1001].spans == "bsd:0:15" and round(got[1001].score, 4) == round(12 / 13, 4)
    assert got[1002].spans == "bsd:38:53,isc:0:19,isc:19:38"


def test_odd_rows(odd_docs, no_docs):
    assert scan_licenses(no_docs).count() == 0
    rows = scan_licenses(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert sum(r.doc_id == 103 for r in rows) == 2


MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish
distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the
following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the
software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of
merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any
claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software
or the use or other dealings in the software"""


def brute_spans(text, sentences):
    """(label:first:end, cover) of whole templates: the span is looked for at
    every start, whatever lies between its words."""
    w, out = words(text), []
    for s, label in sentences:
        t = words(s)
        for i in range(len(w)):
            if w[i:i + len(t)] == t:
                out.append((f"{label}:{i}:{i + len(t)}", 1.0))
    return out


def test_whole_license_texts(spark):
    """Templates of more words than one long has bits."""
    rng = random.Random(3)
    sentences = ((MIT, "mit-text"), (" ".join(f"q{i}" for i in range(64)), "even"), (" ".join(f"r{i}" for i in range(65)), "odd"),
                 (" ".join(f"s{i % 90}" for i in range(700)), "loop"))
    exact = [("x y " * rng.randrange(9)) + s + " z" * rng.randrange(9) for s, _ in sentences]
    changed = [" ".join(w for w in words(s) if rng.random() > 0.05) for s, _ in sentences[:1]]
    half = [" ".join(words(s)[:len(words(s)) // 2]) for s, _ in sentences[:3]]
    rows = list(enumerate([*exact, *changed, *half, None, "", exact[0] + " " + exact[2]]))
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), sentences=sentences).collect()}
    for i, text in rows:
        want = brute_spans(text, sentences)
        if want and i != 3:  # a text that repeats its own words has several diagonals of the same cover
            assert got[i].spans == ",".join(sorted(s for s, _ in want)) and got[i].score == 1
    assert got[3].labels == "loop" and got[3].score == 1 and got[len(exact)].labels == "mit-text" and 0.8 <= got[len(exact)].score < 1
    assert all(got[len(exact) + 1 + i].labels == "" for i in range(3))
