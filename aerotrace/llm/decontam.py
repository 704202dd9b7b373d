"""Benchmark decontamination by SimHash of item-sized windows.

For a benchmark item of L words every window of L words of a document is a
candidate.  A window that shares no shingle with any item has similarity 0, so
only windows around shared shingles are fingerprinted; that prune loses
nothing.  The features of a fingerprint are (shingle, j-th occurrence in the
window): two windows then share as many features as their weighted shingles
have in common, whatever repeats.  Fingerprints are compared through a multi-index: a 64-bit
fingerprint is cut into 8 blocks, and if two fingerprints differ in at most 23
bits, some block differs in at most 2, so looking up each block's values within
2 bits finds all fingerprints within the radius.  Candidates are verified by
the exact similarity of the shingles, weighted by how often they occur.

The items are the query set: they are broadcast in blocks of bounded size and
each block is one pass over the documents, so a benchmark of any size works.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerotrace.llm.prefix import running_sums
from aerotrace.llm.textops import U64, Words, mix64, text_slices
from aerotrace.session import stage_table

SHINGLE = 5
#: For similarity 0.8 about 9.7 of 64 bits differ (deviation 2.9).
RADIUS, BLOCKS, BLOCK_RADIUS = 23, 8, 2
ITEM_BYTES = 8 << 20  # text bytes of items in one broadcast
#: Text bytes of documents looked at together, and the stretch of shingles
#: whose windows are fingerprinted together (a shingle takes some 1,000 bytes).
#: A worker keeps much of what it once took.
PIECE_BYTES, PIECE_STARTS = 1 << 18, 1 << 13

_BITS = np.array([bin(x).count("1") for x in range(256)], dtype=np.uint8)
#: For each value of a block, the values within BLOCK_RADIUS bits of it.
_NEAR_VALUES = np.arange(256)[:, None] ^ np.flatnonzero(_BITS <= BLOCK_RADIUS)[None, :]


def _bits(features: np.ndarray) -> np.ndarray:
    """The 64 bits of each hashed feature, as a last axis."""
    raw = np.ascontiguousarray(mix64(features).astype("<u8")).view(np.uint8).reshape(*features.shape, 8)
    return np.unpackbits(raw, axis=-1, bitorder="little")


def _repeating(shingles: np.ndarray, size: int) -> np.ndarray:
    """For every start, whether its window of ``size`` holds a shingle twice."""
    order = np.argsort(shingles, kind="stable")
    same = shingles[order[1:]] == shingles[order[:-1]]
    at, before = order[1:][same], order[:-1][same]
    near = at - before < size
    mark = np.zeros(len(shingles) + 2, dtype=np.int64)
    np.add.at(mark, np.maximum(at[near] - size + 1, 0), 1)
    np.add.at(mark, before[near] + 1, -1)
    return np.cumsum(mark[:-2]) > 0


def fingerprints(shingles: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of ``size`` shingles at ``starts``, as 8 bytes each."""
    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(_bits(shingles), axis=0, dtype=np.int32)])
    ones = sums[starts + size] - sums[starts]
    twice = np.flatnonzero(_repeating(shingles, size)[starts])
    step = max(1, (1 << 17) // size)
    for at in range(0, len(twice), step):
        rows = twice[at:at + step]
        window = np.sort(shingles[starts[rows][:, None] + np.arange(size)], axis=1)
        place = np.broadcast_to(np.arange(size), window.shape)
        new = np.concatenate([np.ones((len(rows), 1), bool), window[:, 1:] != window[:, :-1]], axis=1)
        occurrence = place - np.maximum.accumulate(np.where(new, place, 0), axis=1)
        ones[rows] = _bits(window + occurrence.astype(U64) * U64(0x9E3779B97F4A7C15)).sum(axis=1, dtype=np.int32)
    return np.packbits(2 * ones > size, axis=1)


class Group:
    """Items of one length: fingerprints and, for each block, the items in
    order of its value with the bounds of every value (40 bytes an item)."""

    def __init__(self, size: int, ids: list, shingles: list[np.ndarray]):
        self.size, self.ids, self.shingles = size, ids, np.concatenate(shingles)
        self.prints = fingerprints(self.shingles, np.arange(len(ids)) * size, size)
        self.order = np.argsort(self.prints, axis=0, kind="stable").T.astype(np.int32)
        self.bounds = np.stack([np.searchsorted(self.prints[o, b], np.arange(257)) for b, o in enumerate(self.order)]).astype(np.int32)
        self.counts: dict[int, tuple] = {}

    def count(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of an item and how often it has them."""
        if item not in self.counts:
            self.counts[item] = np.unique(self.shingles[item * self.size:(item + 1) * self.size], return_counts=True)
        return self.counts[item]

    def within_radius(self, prints: np.ndarray):
        """(window, item) pairs whose fingerprints differ in at most RADIUS
        bits: those that some block's near values find, by exact distance."""
        step = max(1, (1 << 18) // max(len(self.ids), BLOCKS * _NEAR_VALUES.shape[1]))
        for at in range(0, len(prints), step):
            part = prints[at:at + step]
            pairs = []
            for b in range(BLOCKS):
                values = _NEAR_VALUES[part[:, b]]  # windows x near values
                low = self.bounds[b][values].ravel()
                n = self.bounds[b][values + 1].ravel() - low
                stop = np.cumsum(n)
                item = self.order[b][np.arange(stop[-1]) + np.repeat(low - stop + n, n)]
                window = np.repeat(np.repeat(np.arange(len(part)), values.shape[1]), n)
                pairs.append(window * len(self.ids) + item)
            window, item = np.divmod(np.unique(np.concatenate(pairs)), len(self.ids))
            ok = _BITS[part[window] ^ self.prints[item]].sum(axis=1) <= RADIUS
            yield from zip((window[ok] + at).tolist(), item[ok].tolist())


class Index:
    """The items of one block, by shingle width and number of shingles."""

    def __init__(self, ids: list[int | None], texts: list[str]):
        words = Words(pa.array(texts, pa.string()))
        by: dict[tuple[int, int], list] = {}
        known: dict[int, list] = {}
        for k in range(1, SHINGLE + 1):
            shingles, offsets = words.shingles(k)
            for i in np.flatnonzero(np.minimum(words.counts, SHINGLE) == k):
                own = shingles[offsets[i]:offsets[i + 1]]
                by.setdefault((k, len(own)), []).append((ids[i], own))
        self.groups = {key: Group(key[1], [i for i, _ in rows], [s for _, s in rows]) for key, rows in by.items()}
        for (k, size), rows in by.items():
            for _, own in rows:
                known.setdefault(k, []).append((own, np.full(len(own), size)))
        #: by width: (shingle, group size) pairs sorted by shingle
        self.known = {}
        for k, parts in known.items():
            pairs = np.unique(np.rec.fromarrays([np.concatenate([p[0] for p in parts]),
                                                 np.concatenate([p[1] for p in parts])], names="s,n"))
            self.known[k] = (np.ascontiguousarray(pairs.s), np.ascontiguousarray(pairs.n))
        self.filters: dict[int, np.ndarray] = {}

    def filter(self, k: int) -> np.ndarray:
        """Bits of the shingles of width ``k`` that an item may have (made where it is used)."""
        if k not in self.filters:
            self.filters[k] = np.zeros(1 << 22, dtype=bool)
            self.filters[k][self.known[k][0] & U64((1 << 22) - 1)] = True
        return self.filters[k]

    def scan(self, column: pa.Array):
        """(row, item id, first word, words, similarity) of the best window of
        each text and item at or over the threshold."""
        words = Words(column)
        for k, (shingle, size) in self.known.items():
            own, offsets = words.shingles(k)
            full, bits = words.counts >= k, self.filter(k)
            maybe = np.flatnonzero(bits[own & U64((1 << 22) - 1)])
            lo, hi = np.searchsorted(shingle, own[maybe], "left"), np.searchsorted(shingle, own[maybe], "right")
            maybe, lo, n = maybe[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            place = np.repeat(maybe, n)
            group = size[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
            row = np.searchsorted(offsets, place, "right") - 1
            ok = full[row]
            order = np.lexsort((place[ok], group[ok], row[ok]))
            place, group, row = place[ok][order], group[ok][order], row[ok][order]
            cuts = np.flatnonzero((np.diff(row) != 0) | (np.diff(group) != 0)) + 1
            for at in np.split(np.arange(len(row)), cuts) if len(row) else []:
                r, g = int(row[at[0]]), self.groups[(k, int(group[at[0]]))]
                text = own[offsets[r]:offsets[r + 1]]
                width = min(g.size, len(text))
                hits = place[at] - offsets[r]
                mark = np.zeros(len(text) - width + 2, dtype=np.int32)
                np.add.at(mark, np.maximum(hits - width + 1, 0), 1)
                np.add.at(mark, np.minimum(hits, len(text) - width) + 1, -1)
                starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
                yield from self._verify(r, text, starts, width, g, k)

    @staticmethod
    def _verify(row, text, starts, width, group, k, percent=80):
        best: dict[int, tuple] = {}
        for some in np.split(starts, np.flatnonzero(np.diff(starts // PIECE_STARTS)) + 1):
            first, last = some[0], some[-1] + width
            for w, i in group.within_radius(fingerprints(text[first:last], some - first, width)):
                a = int(some[w])
                keys, counts = group.count(i)
                window = text[a:a + width]
                at = np.minimum(np.searchsorted(keys, window), len(keys) - 1)
                shared = int(np.minimum(np.bincount(at[keys[at] == window], minlength=len(keys)), counts).sum())
                union = width + group.size - shared
                if 100 * shared >= percent * union and (i not in best or shared / union > best[i][1]):
                    best[i] = (a, shared / union)
        for i, (a, similarity) in best.items():
            yield row, group.ids[i], a, width + k - 1, similarity


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id_col, item_id, first_word, n_words, similarity): for each document
    and benchmark item with a window of the item's length whose weighted
    similarity over 5-word shingles is at least 0.8, the best such window
    (ties: the first).  A document shorter than the item is one window.

    Words are maximal runs without ASCII white space, A-Z lower-cased.  Items
    of 1 to 4 words are one shingle and must stand in the text whole.  Null,
    empty and blank texts and items match nothing; null document and item ids
    are carried; repeated rows are matched each; empty
    tables give an empty result; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, item_id long, first_word long, n_words long, similarity double"
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = docs.sparkSession.createDataFrame([], schema)
    for index in _item_blocks(benchmark, item_col, item_text_col):
        found = found.unionByName(source.mapInArrow(_scanner(index), schema))
    return found.withColumnRenamed("id", id_col)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a match, with all their columns; one pass
    per block of items and no join.  An item without an id counts like any
    other; null, empty and blank texts match nothing and stay; repeated rows
    are judged each; empty tables drop nothing."""
    for index in _item_blocks(benchmark, item_col, item_text_col):
        docs = docs.mapInArrow(_filter(index, text_col), docs.schema)
    return docs


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str):
    """Broadcast indexes of the items, at most ITEM_BYTES of text (and one item) each."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text")).where(
        "text IS NOT NULL").withColumn("bytes", F.octet_length("text").cast("long"))
    items = stage_table(running_sums(items, [F.col("item").asc_nulls_last(), F.col("text")], {"before": "bytes"}).withColumn(
        "block", F.floor(F.col("before") / ITEM_BYTES)), "benchmark")
    last = items.agg(F.max("block").alias("n")).first()["n"]
    for block in range(0 if last is None else last + 1):
        rows = items.where(F.col("block") == block).select("item", "text").collect()
        if rows:
            yield spark.sparkContext.broadcast(Index([r["item"] for r in rows], [r["text"] for r in rows]))


def _filter(index, text_col: str):
    def run(batches):
        for batch in batches:
            for start, end in text_slices(batch, text_col, PIECE_BYTES):
                part = batch.slice(start, end - start)
                keep = np.ones(part.num_rows, dtype=bool)
                keep[[hit[0] for hit in index.value.scan(part.column(text_col))]] = False
                yield part.filter(pa.array(keep))

    return run


def _scanner(index):
    def run(batches):
        for batch in batches:
            for start, end in text_slices(batch, "text", PIECE_BYTES):
                part = batch.slice(start, end - start)
                hits = list(index.value.scan(part.column("text")))
                if hits:
                    row, item, first, n, similarity = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(pa.array(row)), pa.array(item, pa.int64()), pa.array(first, pa.int64()),
                         pa.array(n, pa.int64()), pa.array(similarity, pa.float64())],
                        names=["id", "item_id", "first_word", "n_words", "similarity"])

    return run


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of all documents that match an item of ``benchmark``."""
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
