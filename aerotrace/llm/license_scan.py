"""License scan by diagonal voting.

All rolling two-word grams of the documents are joined with the grams of the
license phrases.  A hit at document word p and phrase word q lies on diagonal
p - q; a phrase that stands in a text puts all its grams on one diagonal, and
an inserted or missing word moves the rest to a neighbouring one.  Votes are
counted per diagonal, neighbouring diagonals are merged whatever their votes,
and a merged span is verified by the share of the phrase's grams that it holds
and by its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerotrace.llm.textops import U64, Words, span_hash, text_slices

GRAM = 2
#: Fixed phrases whose every exact place counts: (words, label).
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Well-known sentences of public licenses, found also with small changes.
SENTENCES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0 the license", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
)
NEIGHBOUR = 3  # diagonals this near each other belong to one span
LEAST_COVER = 0.8  # share of a phrase's grams that a span needs
MOST_STRETCH = 1.5  # longest span, in phrase lengths
BROADCAST_GRAMS = 100_000
BITS = 63  # grams in one long; a phrase of more has several

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[0:0x30] = False
_IS_WORD[0x3A:0x61] = False
_IS_WORD[0x7B:0x80] = False


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text offsets) of the two-word grams in order."""
    counts = np.maximum(words.counts - GRAM + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    first = words.offsets[text] + np.arange(offsets[-1]) - offsets[text]
    return words.hash[first] * U64(0x9E3779B97F4A7C15) ^ words.hash[first + 1], offsets


def phrase_grams(spark: SparkSession, base=BASE_PHRASES, sentences=SENTENCES) -> DataFrame:
    """(gram, phrase, label, exact, q, n): gram q of n of each phrase."""
    rows = []
    phrases = [(p, label, True) for p, label in base] + [(p, label, False) for p, label in sentences]
    words = Words(pa.array([p for p, _, _ in phrases]), is_word=_IS_WORD)
    gram, offsets = _grams(words)
    for i, (_, label, exact) in enumerate(phrases):
        own = gram[offsets[i]:offsets[i + 1]].view(np.int64).tolist()
        if not own:
            raise ValueError("a phrase needs two words")
        rows += [(g, i, label, exact, q, len(own)) for q, g in enumerate(own)]
    table = spark.createDataFrame(rows, "gram long, phrase int, label string, exact boolean, q int, n int")
    return F.broadcast(table) if len(rows) <= BROADCAST_GRAMS else table


def gram_sets(base=BASE_PHRASES, sentences=SENTENCES) -> int:
    """Longs that hold a bit for each gram of the longest phrase."""
    words = Words(pa.array([p for p, _ in (*base, *sentences)]), is_word=_IS_WORD)
    return max(1, -(-int(words.counts.max(initial=0) - GRAM + 1) // BITS))


def document_grams(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, version, p, gram): every gram of every text at its word p, and one
    row with p = -1 and the number of words in place of the gram.  ``version``
    hashes the text, which keeps rows apart that share an id."""

    def run(batches):
        for batch in batches:
            for start, end in text_slices(batch, "text", 1 << 20):
                part = batch.slice(start, end - start)
                words = Words(part.column("text"), is_word=_IS_WORD)
                gram, offsets = _grams(words)
                counts = np.diff(offsets)
                text = np.repeat(np.arange(len(counts)), counts)
                version = span_hash(words.sums, words.text_offsets[:-1], words.text_offsets[1:]).view(np.int64)
                rows = np.concatenate([np.arange(len(counts)), text])
                place = np.concatenate([np.full(len(counts), -1), np.arange(len(text)) - offsets[text]])
                value = np.concatenate([words.counts.astype(np.int64), gram.view(np.int64)])
                for at in range(0, len(rows), 1 << 18):
                    own = rows[at:at + (1 << 18)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(pa.array(own)), pa.array(version[own]),
                         pa.array(place[at:at + (1 << 18)].astype(np.int32)), pa.array(value[at:at + (1 << 18)])],
                        names=["id", "version", "p", "gram"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, version long, p int, gram long")


def merged_spans(group: np.ndarray, diagonal: np.ndarray, grams: np.ndarray, n: np.ndarray):
    """(group, first word, end word, grams found) of the verified spans of each
    group, whose diagonals come sorted; ``grams`` (rows of longs) are bit sets
    of the ``n`` phrase grams that a diagonal holds.

    Runs of neighbouring diagonals are tried from every diagonal on.  Of those
    that hold enough grams in a short enough span the fullest is taken, then
    the shortest; its diagonals take part in no other span."""
    low, high = diagonal + lowest_bit(grams), diagonal + highest_bit(grams) + GRAM
    most = MOST_STRETCH * (n + GRAM - 1)
    start = np.arange(len(group))
    have, count, first, end = grams.copy(), np.zeros(len(group), np.int64), low.copy(), high.copy()
    found, step = [], 0
    while len(start):
        last = start + step
        now = bits_set(have)
        good = (now > count) & (now >= LEAST_COVER * n[start]) & (end - first <= most[start])
        found.append(np.stack([start, last, first, end, now], axis=1)[good])
        step += 1
        follow = np.minimum(last + 1, len(group) - 1)
        go = ((last + 1 < len(group)) & (group[follow] == group[start]) & (diagonal[follow] - diagonal[last] <= NEIGHBOUR)
              & (diagonal[follow] - diagonal[start] <= most[start] + n[start]))
        start, follow, count = start[go], follow[go], now[go]
        have, first, end = have[go] | grams[follow], np.minimum(first[go], low[follow]), np.maximum(end[go], high[follow])
    runs = np.concatenate(found) if found else np.zeros((0, 5), np.int64)
    runs = runs[np.lexsort((runs[:, 0], runs[:, 1] - runs[:, 0], runs[:, 3] - runs[:, 2], -runs[:, 4]))]
    used, out = np.zeros(len(group), dtype=bool), []
    for i, (a, b) in enumerate(runs[:, :2].tolist()):
        if not used[a:b + 1].any():
            used[a:b + 1] = True
            out.append(i)
    runs = runs[out]
    return group[runs[:, 0]], runs[:, 2], runs[:, 3], runs[:, 4]


def bits_set(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1).astype(np.int64)


def lowest_bit(x: np.ndarray) -> np.ndarray:
    """Place of the lowest bit of each row of longs (a row has one at least)."""
    word = (x != 0).argmax(axis=1)
    own = x[np.arange(len(x)), word]
    return word * BITS + np.bitwise_count((own & -own) - 1).astype(np.int64)


def highest_bit(x: np.ndarray) -> np.ndarray:
    word = x.shape[1] - 1 - (x[:, ::-1] != 0).argmax(axis=1)
    own = x[np.arange(len(x)), word]
    for shift in (1, 2, 4, 8, 16, 32):  # every bit below the highest one
        own = own | own >> shift
    return word * BITS + np.bitwise_count(own).astype(np.int64) - 1


def _verified(groups: DataFrame) -> DataFrame:
    """``groups(id, version, phrase, label, exact, n, n_words, copies, cells)``
    -> their spans (first, end, found); a group without a phrase stays as it
    is.  A cell is a diagonal with the set of grams on it."""
    kept = ["id", "version", "phrase", "label", "exact", "n_words", "copies"]

    def run(batches):
        for batch in batches:
            cells = batch.column("cells")
            sizes = np.diff(np.asarray(cells.offsets).astype(np.int64))
            cells = cells.flatten()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            diagonal = cells.field("diagonal").to_numpy(zero_copy_only=False).astype(np.int64)
            lists = cells.field("grams")
            grams = np.asarray(lists.flatten()).astype(np.int64).reshape(len(lists), -1) if len(lists) else np.zeros((0, 1), np.int64)
            n = batch.column("n").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            exact = batch.column("exact").fill_null(False).to_numpy(zero_copy_only=False)[row]
            inexact = np.flatnonzero(~exact)
            part = merged_spans(row[inexact], diagonal[inexact], grams[inexact], n[row[inexact]])
            own = np.flatnonzero(exact)  # each of these diagonals has all grams
            alone = np.flatnonzero(batch.column("phrase").is_null().to_numpy(zero_copy_only=False))
            none = np.full(len(alone), -1)
            who, first, end, have = (np.concatenate(x) for x in zip(
                part, (row[own], diagonal[own], diagonal[own] + n[row[own]] + GRAM - 1, n[row[own]]), (alone, none, none, none)))
            blank = first < 0
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(who)) for c in kept), pa.array(first.astype(np.int32), mask=blank),
                 pa.array(end.astype(np.int32), mask=blank), pa.array(have / np.maximum(n[who], 1), mask=blank)],
                names=[*kept, "first", "end", "cover"])

    types = {f.name: f.dataType.simpleString() for f in groups.schema.fields}
    return groups.mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in kept) + ", first int, end int, cover double")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE_PHRASES,
                  sentences=SENTENCES) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base (exact places of base
    phrases), first_word and last_word (their smallest and largest start),
    base_labels, labels (with those of verified sentences), score (best share
    of a phrase found: 1 for a base phrase), spans (label:first:end words).

    A-Z is lower-cased; words are runs of 0-9, a-z and all non-ASCII
    characters.  Null, empty and wordless texts have n_words 0, no labels and
    score 0.  A template may be of any length, a whole license text too.  Null ids and rows that share an id are scanned each; exact
    repeats of a row are all returned.  An empty table gives an empty result;
    other columns of ``docs`` are ignored.
    """
    phrases, n_sets = phrase_grams(docs.sparkSession, base, sentences), gram_sets(base, sentences)
    hits = document_grams(docs, id_col, text_col).join(phrases, "gram", "left").where("p < 0 OR phrase IS NOT NULL")
    is_row = F.col("p") < 0
    votes = (hits.withColumn("diagonal", F.when(~is_row, F.col("p") - F.col("q")))
             .withColumn("phrase", F.when(~is_row, F.col("phrase")))
             .groupBy("id", "version", "phrase", "diagonal").agg(
                 F.count("*").alias("votes"), *[F.bit_or(F.when(~is_row & (F.expr(f"q div {BITS}") == i), F.expr(f"shiftleft(1L, q % {BITS})"))).alias(f"grams{i}")
                                        for i in range(n_sets)],
                 F.max(F.when(is_row, F.col("gram"))).alias("n_words"), F.first("label").alias("label"),
                 F.first("exact").alias("exact"), F.first("n").alias("n")))
    sets = [f"grams{i}" for i in range(n_sets)]
    held = sum((F.coalesce(F.bit_count(c), F.lit(0)) for c in sets), F.lit(0))
    whole = F.col("phrase").isNull() | ~F.col("exact") | (held == F.col("n"))
    packed = F.array(*[F.coalesce(c, F.lit(0).cast("long")) for c in sets]).alias("grams")
    cell = F.when(F.col("phrase").isNotNull(), F.struct("diagonal", packed))
    # no span can hold more of a phrase's grams than its text
    groups = (votes.where(whole).groupBy("id", "version", "phrase").agg(
        F.max("label").alias("label"), F.max("exact").alias("exact"), F.max("n").alias("n"), F.max("n_words").alias("n_words"),
        F.max("votes").alias("copies"), F.array_sort(F.collect_list(cell)).alias("cells"), *[F.bit_or(c).alias(c) for c in sets])
        .where(F.col("phrase").isNull() | (held >= LEAST_COVER * F.col("n"))).drop(*sets))
    found = _verified(groups)
    text = F.when(F.col("phrase").isNotNull(), F.concat_ws(":", "label", F.col("first").cast("string"), F.col("end").cast("string")))
    label = F.when(F.col("phrase").isNotNull(), F.col("label"))
    per_row = found.groupBy("id", "version").agg(
        F.max("n_words").alias("n_words"),
        F.sum(F.when(F.col("exact"), 1).otherwise(0)).alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("exact"), label))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(label)), ",").alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.array_join(F.array_sort(F.collect_set(text)), ",").alias("spans"),
        F.max(F.when(F.col("phrase").isNull(), F.col("copies"))).alias("copies"))
    return per_row.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases of all documents."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
