"""Alignment of two tokenizers over the same texts.

The tokens of both tokenizers tile the bytes of a text.  For each batch of
texts two ``merge_asof`` joins, on (document, offset) as one number, find for every token start
the token of the other side that covers it; the union of both directions is
every overlapping pair, and pairs with equal ends cut the text into groups.
All A and B tokens of one group are linked.

How often an id pair is linked over the corpus takes a second step.  A task
takes its documents in slices and writes one row per document, with the places
of its pairs in the slice's list of distinct pairs; the slice's first row has
that list, each pair with the number of its documents.  Only the lists are
exploded and summed (one row per slice and pair, pre-aggregated, so a pair that
every document holds is a few rows), and the counts of a slice's pairs meet its
documents in one task as rows.  Outside Python only one Arrow batch at a time
holds a slice, so memory does not depend on how many slices a task has.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerotrace.llm.textops import text_slices
from aerotrace.llm.tokens import _END, _OTHER, _SPACE, Encoder, vocabulary_path
from aerotrace.session import stage_table

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Per-document distinct pairs in one stored slice, about; a document is never split.
SLICE_PAIRS = 1 << 18
PIECE_BYTES = 1 << 18  # text bytes aligned at once
CACHE = 1 << 18  # encoded parts that each tokenizer keeps in a worker
#: Groups with at most so many pairs are expanded at once; larger ones by their distinct ids.
PLAIN_PAIRS = 64
#: Bytes of a Parquet row group of staged documents, about: a task holds one while it writes or reads.
GROUP_BYTES = 8 << 20
MARK = "▁"


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable bytes stand
    for themselves, the others for the characters from 256 on, in order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteTokens(Encoder):
    """A byte-level vocabulary: ids of " " + text, and the bytes of each id.
    Strings of special tokens inside texts are ordinary text."""

    def __init__(self, path: str):
        super().__init__(path, CACHE)
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        entries = [self.tokenizer.id_to_token(i) or "" for i in range(self.vocabulary_size)]
        self.bytes = [bytes(alphabet[c] for c in e) if all(c in alphabet for c in e) else e.encode() for e in entries]


class _Pieces:
    """The two calls that ``Encoder`` makes, over a sentencepiece model; texts
    begin with the blank that the model itself adds."""

    def __init__(self, model):
        self.model, self.blank = model, [model.piece_to_id(MARK)]

    class Ids:
        def __init__(self, ids):
            self.ids = ids

    def encode(self, text, add_special_tokens=False):
        return self.Ids(self.model.encode(text[1:], num_threads=1))

    def encode_batch_fast(self, pieces, add_special_tokens=False):
        return [self.Ids(self.blank if p == " " else ids)
                for p, ids in zip(pieces, self.model.encode([p[1:] for p in pieces], num_threads=1))]


class PieceTokens(Encoder):
    """A sentencepiece model.  Where no piece has a blank after another
    character, merges never cross into a run of blanks, so a text is cut in
    front of each run and the parts are encoded once each and kept."""

    def __init__(self, path: str, cache: int = CACHE):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        self.tokenizer, self.vocabulary_size = _Pieces(model), model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(self.vocabulary_size)]
        self.by_piece = not any(MARK in p.lstrip(MARK) for p in pieces) and self.tokenizer.blank != [model.unk_id()]
        self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.added = []
        self.classes = np.full(1 << 16, _OTHER, dtype=np.uint8)
        self.classes[0x20], self.classes[0] = _SPACE, _END
        self.most = cache
        self._clear()

    @staticmethod
    def starts_of(code: np.ndarray, kind: np.ndarray) -> np.ndarray:
        before = np.concatenate([[_END], kind[:-1]])
        return (kind == _END) | (before == _END) | (kind == _SPACE) & (before != _SPACE)


_sides: dict[tuple[str, str], tuple] = {}


class Side:
    """A tokenizer with its token bytes as one buffer."""

    def __init__(self, tokens: Encoder):
        self.tokens = tokens
        self.size = np.array([len(b) for b in tokens.bytes], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens.bytes), dtype=np.uint8)
        digits = [str(i).encode() for i in range(len(tokens.bytes))]
        self.n_digits = np.array([len(d) for d in digits], dtype=np.int64)
        self.digits = np.zeros((len(digits), int(self.n_digits.max())), dtype=np.uint8)
        for i, d in enumerate(digits):
            self.digits[i, :len(d)] = np.frombuffer(d, dtype=np.uint8)

    def written(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, joined."""
        n = self.size[ids]
        end = np.cumsum(n)
        return self.flat[np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[ids] - end + n, n)]


def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    """Both tokenizers, once per Python worker."""
    key = (path_a, path_b)
    if key not in _sides:
        _sides[key] = tuple(Side(PieceTokens(p) if p.endswith(".model") else ByteTokens(p)) for p in key)
    return _sides[key]


class Aligned:
    """Tokens of a list of texts under both tokenizers, cut into groups.

    ids, doc, start, end and group per token of each side (index 0: A, 1: B);
    texts that are empty, or that a side does not give back byte for byte,
    have no tokens."""

    def __init__(self, both: tuple[Side, Side], texts: list[str]):
        self.n = len(texts)
        spaced = [" " + t for t in texts]
        raw = [t.encode() for t in spaced]
        size = np.array([len(r) for r in raw], dtype=np.int64)
        coded = [s.tokens.encode(spaced) for s in both]
        docs = [np.repeat(np.arange(self.n), counts) for _, counts in coded]
        good = size > 1
        for s, (ids, _), doc in zip(both, coded, docs):
            good &= np.bincount(doc, weights=s.size[ids], minlength=self.n).astype(np.int64) == size
            want = np.frombuffer(b"".join(r for r, g in zip(raw, good) if g), dtype=np.uint8)
            wrong = np.flatnonzero(s.written(ids[good[doc]]) != want)
            if len(wrong):
                held = np.flatnonzero(good)
                good[held[np.unique(np.searchsorted(np.cumsum(size[held]), wrong, side="right"))]] = False
        self.good = good
        self.ids = [ids[good[doc]].astype(np.int64) for (ids, _), doc in zip(coded, docs)]
        self.doc = [doc[good[doc]] for doc in docs]
        self.end = [np.cumsum(s.size[ids]) for s, ids in zip(both, self.ids)]
        self.start = [end - s.size[ids] for s, ids, end in zip(both, self.ids, self.end)]
        self.base = np.cumsum(np.where(good, size, 0)) - np.where(good, size, 0)  # of each text's bytes
        a, b = self.overlaps()
        equal = self.end[0][a] == self.end[1][b]
        self.closes = [np.zeros(len(ids), dtype=bool) for ids in self.ids]
        self.closes[0][a[equal]] = True
        self.closes[1][b[equal]] = True
        self.group = [np.cumsum(c) - c for c in self.closes]
        self.n_groups = int(self.closes[0].sum())

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """All (A token, B token) pairs that share a byte, some twice.

        Offsets run on from text to text and both sides begin a text at the
        same one; with the text's number added, no text's key reaches the
        next text's first, so a match never leaves its text."""
        frames = [pd.DataFrame({"start": s + d, name: np.arange(len(s))}) for s, d, name in zip(self.start, self.doc, "ab")]
        if not len(frames[0]):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        one = pd.merge_asof(frames[0], frames[1], on="start")
        two = pd.merge_asof(frames[1], frames[0], on="start")
        return (np.concatenate([one["a"].to_numpy(np.int64), two["a"].to_numpy(np.int64)]),
                np.concatenate([one["b"].to_numpy(np.int64), two["b"].to_numpy(np.int64)]))

    def linked(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, A id * width + B id, times) of the distinct linked pairs of
        each text, in order."""
        sizes = [np.bincount(g, minlength=self.n_groups) for g in self.group]
        firsts = [np.cumsum(n) - n for n in sizes]
        plain = sizes[0] * sizes[1] <= PLAIN_PAIRS
        at = np.flatnonzero(plain[self.group[0]])  # A tokens of plain groups, each with every B token of its group
        g = self.group[0][at]
        n = sizes[1][g]
        stop = np.cumsum(n)
        other = np.arange(stop[-1] if len(stop) else 0) + np.repeat(firsts[1][g] - stop + n, n)
        docs = [np.repeat(self.doc[0][at], n)]
        codes = [np.repeat(self.ids[0][at], n) * width + self.ids[1][other]]
        times = [np.ones(len(other), dtype=np.int64)]
        for x in np.flatnonzero(~plain):
            (ia, na), (ib, nb) = [np.unique(self.ids[s][firsts[s][x]:firsts[s][x] + sizes[s][x]], return_counts=True) for s in (0, 1)]
            codes.append((ia[:, None] * width + ib[None, :]).ravel())
            times.append((na[:, None] * nb[None, :]).ravel())
            docs.append(np.full(len(codes[-1]), self.doc[0][firsts[0][x]]))
        doc, code, time = np.concatenate(docs), np.concatenate(codes), np.concatenate(times)
        if not len(doc):
            return doc, code, time
        span = int(code.max()) + 1
        if self.n * span < 1 << 63:  # one sort key holds both
            key = doc * span + code
            order = np.argsort(key)
            key, time = key[order], time[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            return *np.divmod(key[first], span), np.add.reduceat(time, first)
        order = np.lexsort((code, doc))
        doc, code, time = doc[order], code[order], time[order]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(code) != 0)]))
        return doc[first], code[first], np.add.reduceat(time, first)

    def digests(self, both: tuple[Side, Side]) -> list[str]:
        """Hex SHA-256 of ``a,a|b;a|b,b`` per text; '' without tokens."""
        n_a, n_b = (np.bincount(g, minlength=self.n_groups) for g in self.group)
        place = [np.arange(len(self.ids[0])) + (np.cumsum(n_b) - n_b)[self.group[0]],
                 np.arange(len(self.ids[1])) + np.cumsum(n_a)[self.group[1]]]
        total = len(self.ids[0]) + len(self.ids[1])
        width = np.zeros(total, dtype=np.int64)
        for s, p, ids in zip(both, place, self.ids):
            width[p] = s.n_digits[ids] + 1
        end = np.cumsum(width)
        out = np.full(end[-1] if total else 0, ord(","), dtype=np.uint8)
        for s, p, ids, close, mark in zip(both, place, self.ids, self.closes, b"|;"):
            start, n = end[p] - width[p], s.n_digits[ids]
            for d in range(s.digits.shape[1]):
                has = n > d
                out[start[has] + d] = s.digits[ids[has], d]
            out[end[p[close]] - 1] = mark
        tokens = [np.bincount(d, minlength=self.n) for d in self.doc]
        last = np.cumsum(tokens[0] + tokens[1])
        digests, at, view = [], 0, memoryview(out.tobytes())
        for t in last.tolist():
            stop = int(end[t - 1]) if t else 0
            digests.append(hashlib.sha256(view[at:stop - 1]).hexdigest() if stop > at else "")
            at = stop
        return digests

    def per_text(self, side: int) -> np.ndarray:
        return np.bincount(self.doc[side], minlength=self.n)


def _pieces(batches, path_a: str, path_b: str, ids: bool = True):
    """(ids column, Aligned) of parts of about PIECE_BYTES of text."""
    both = sides(path_a, path_b)
    for batch in batches:
        for start, end in text_slices(batch, "text", PIECE_BYTES):
            part = batch.slice(start, end - start)
            yield part.column("id"), Aligned(both, [t or "" for t in part.column("text").to_pylist()])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def token_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
                 path_b: str | None = None) -> DataFrame:
    """One row per group: (id_col, n (from 0), start, end (bytes of space +
    text), a_ids, b_ids).  Rules as in ``alignment``."""
    path_a, path_b = path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for ids, x in _pieces(batches, path_a, path_b):
            doc = x.doc[0][x.closes[0]]
            end = x.end[0][x.closes[0]] - x.base[doc]
            n = np.arange(len(doc)) - np.searchsorted(doc, doc)
            start = np.where(n > 0, np.concatenate([[0], end[:-1]]), 0)
            lists = [pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.bincount(g, minlength=x.n_groups))]).astype(np.int32)),
                pa.array(i.astype(np.int32))) for g, i in zip(x.group, x.ids)]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), pa.array(n), pa.array(start), pa.array(end), *lists],
                                             names=["id", "n", "start", "end", "a_ids", "b_ids"])

    return _rows(docs, id_col, text_col).mapInArrow(
        run, f"id {kind}, n long, start long, end long, a_ids array<int>, b_ids array<int>").withColumnRenamed("id", id_col)


_DOC = ("n_a", "n_b", "n_groups", "n_links")


def _packed(values: np.ndarray, per_row: np.ndarray) -> pa.Array:
    """``per_row`` numbers in a row as bytes, each in the fewest that hold the largest."""
    values = values.astype(np.min_scalar_type(values.max(initial=0)))
    stop = np.concatenate([[0], np.cumsum(per_row)]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(per_row), [None, pa.py_buffer(stop.astype(np.int32)), pa.py_buffer(values)])


def _unpacked(column, n: int) -> np.ndarray:
    """The ``n`` numbers of all rows of a slice's packed column, in order."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype=f"u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _slices(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    longs = "".join(f", {c} long" for c in _DOC)
    schema = (f"part int, slice int, id {kind}{longs}, digest string, held int, place binary, times binary, "
              "pair_a array<int>, pair_b array<int>, pair_docs array<int>")

    def run(batches):
        from pyspark import TaskContext
        part, number = TaskContext.get().partitionId(), 0
        both = sides(path_a, path_b)
        width = len(both[1].size)
        ids, docs_of, digests, codes, times, held = [], [], [], [], [], []

        def rows():
            code = np.concatenate(codes)
            pairs, pair = np.unique(code, return_inverse=True)
            n_docs = np.bincount(pair, minlength=len(pairs))  # a document holds a pair once
            per, links = np.concatenate(docs_of, axis=1), np.concatenate(held)
            n = len(links)
            lists = np.full(n + 1, len(pairs), dtype=np.int32)  # all of the list in the first row
            lists[0] = 0
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, number, np.int32)), pa.concat_arrays(ids),
                 *[pa.array(x) for x in per], pa.array(digests, pa.string()), pa.array(links.astype(np.int32)),
                 _packed(pair, links), _packed(np.concatenate(times), links),
                 *[pa.ListArray.from_arrays(pa.array(lists), pa.array(x.astype(np.int32)))
                   for x in (pairs // width, pairs % width, n_docs)]],
                names=["part", "slice", "id", *_DOC, "digest", "held", "place", "times", "pair_a", "pair_b", "pair_docs"])

        for column, x in _pieces(batches, path_a, path_b):
            doc, code, time = x.linked(width)
            links = np.bincount(doc, weights=None, minlength=x.n)
            total = np.zeros(x.n, dtype=np.int64)
            np.add.at(total, doc, time)
            ids.append(column)
            docs_of.append(np.stack([x.per_text(0), x.per_text(1), np.bincount(x.doc[0][x.closes[0]], minlength=x.n), total]).astype(np.int64))
            digests += x.digests(both)
            codes.append(code), times.append(time), held.append(links)
            if sum(map(len, codes)) >= SLICE_PAIRS:
                yield rows()
                ids, docs_of, digests, codes, times, held = [], [], [], [], [], []
                number += 1
        if ids:
            yield rows()

    return _rows(docs, id_col, text_col).mapInArrow(run, schema)


def pair_counts(slices: DataFrame) -> DataFrame:
    """(pair_a, pair_b, count, best): documents that hold a pair linked, and
    whether no pair of that A id is held by more."""
    from pyspark.sql import Window
    each = slices.select(F.explode(F.arrays_zip("pair_a", "pair_b", "pair_docs")).alias("x")).select("x.*")
    counts = each.groupBy("pair_a", "pair_b").agg(F.sum("pair_docs").alias("count"))
    most = F.max("count").over(Window.partitionBy("pair_a"))  # at most one row per B id
    return counts.withColumn("best", F.col("count") == most)


def alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
              path_b: str | None = None) -> DataFrame:
    """One row per row of ``docs``: (id_col, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256).

    Both tokenizers encode space + text without special tokens.  Byte offsets
    where a token of each side ends cut the tokens into groups; all A and B
    tokens of a group are linked.  A pair of ids counts the documents (rows)
    that hold it linked; n_best counts the links whose pair has the highest
    count of its A id, count_sum adds up the counts of all links.

    Null and empty texts, and texts that a tokenizer does not give back byte
    for byte, have no tokens: zeros and ''.  Null ids are carried; repeated
    rows are documents of their own; an empty table gives an empty result;
    other columns are ignored.
    """
    path_a, path_b = path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B)
    slices = stage_table(_slices(docs, id_col, text_col, path_a, path_b), "align-slices", row_group=GROUP_BYTES)
    counts = stage_table(pair_counts(slices), "align-pairs")
    places = slices.select(F.col("part").alias("of_part"), F.col("slice").alias("of_slice"), F.posexplode(
        F.arrays_zip("pair_a", "pair_b")).alias("pos", "x")).select("of_part", "of_slice", "pos", "x.*")
    known = places.join(counts, ["pair_a", "pair_b"]).select("of_part", "of_slice", "pos", "count", "best")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(mine, known):  # documents of one slice, and the counts of its pairs
        held = mine.column("held").to_numpy()
        place, times = (_unpacked(mine.column(c), int(held.sum())) for c in ("place", "times"))
        doc, pos = np.repeat(np.arange(len(held)), held), known.column("pos").to_numpy()
        sums = []
        for c in ("best", "count"):
            of_pair, total = np.zeros(len(pos), dtype=np.int64), np.zeros(len(held), dtype=np.int64)
            of_pair[pos] = known.column(c).to_numpy()
            np.add.at(total, doc, times * of_pair[place])
            sums.append(pa.array(total))
        return pa.Table.from_arrays([mine.column("id"), *[mine.column(c) for c in _DOC], *sums, mine.column("digest")],
                                    names=["id", *_DOC, "n_best", "count_sum", "groups_sha256"])

    longs = ", ".join(f"{c} long" for c in (*_DOC, "n_best", "count_sum"))
    return (slices.drop("pair_a", "pair_b", "pair_docs").groupBy("part", "slice").cogroup(known.groupBy("of_part", "of_slice"))
            .applyInArrow(run, f"id {kind}, {longs}, groups_sha256 string").withColumnRenamed("id", id_col))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both public tokenizers aligned over all documents."""
    return alignment(spark.read.parquet(f"{sf_dir}/documents.parquet"))
