"""Tokenizer access inside Arrow tasks, exact length histograms, and
bit-packed token files.

Encoding goes through the ``tokenizers`` library.  For byte-level BPE models
the ids of a text are the ids of its pre-tokens in order, so each distinct
pre-token is encoded once per task and kept; texts are cut into pre-tokens by
a few numpy passes over code points.  Texts with code points whose class is
not the same in all Unicode versions, or that spell an added token, go to the
library whole.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerotrace.llm.prefix import running_sums
from aerotrace.llm.textops import U64, mix64, span_hash, text_slices
from aerotrace.session import shared_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
_LETTER, _NUMBER, _SPACE, _OTHER, _END, _UNSURE = range(6)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _class_table() -> np.ndarray:
    """Class of each code point of the basic plane.  Only code points that
    Unicode 3.2 already had, with an unchanged class, count as known."""

    def kind(category: str) -> int:
        return {"L": _LETTER, "N": _NUMBER, "Z": _SPACE}.get(category[0], _OTHER)

    table = np.full(1 << 16, _UNSURE, dtype=np.uint8)
    for cp in range(1 << 16):
        old, new = unicodedata.ucd_3_2_0.category(chr(cp)), unicodedata.category(chr(cp))
        if old[0] != "C" and kind(old) == kind(new):
            table[cp] = kind(new)
    table[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _SPACE
    table[0x180E] = table[0x200B] = _UNSURE
    table[0] = _END
    return table


class Encoder:
    """Ids of many texts at once.  ``cache`` bounds the kept pre-tokens."""

    def __init__(self, path: str, cache: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                         and not spec.get("normalizer") and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout"))
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.vocabulary_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.classes = _class_table()
        self.most = cache
        self._clear()

    def _clear(self):
        self.slots = 4 * self.most
        self.table_key = np.zeros(self.slots, dtype=U64)
        self.table_entry = np.zeros(self.slots, dtype=np.int32)
        self.n = 0
        self.starts, self.lens, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where absent (open addressing, all at once)."""
        entry = np.full(len(keys), -1, dtype=np.int32)
        slot = (keys % U64(self.slots)).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            found = self.table_key[slot]
            hit = found == keys[todo]
            entry[todo[hit]] = self.table_entry[slot[hit]]
            more = ~hit & (found != 0)
            todo, slot = todo[more], (slot[more] + 1) % self.slots
        return entry

    def _add(self, keys: np.ndarray, pieces: list[str]) -> None:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        self._store(keys, encoded)

    def _store(self, keys: np.ndarray, encoded: list[list[int]]) -> None:
        lens = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        flat = np.fromiter((i for e in encoded for i in e), dtype=np.uint32, count=int(lens.sum()))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.flat = np.concatenate([self.flat, flat])
        todo = np.arange(len(keys))
        slot = (keys % U64(self.slots)).astype(np.int64)
        while len(todo):
            free = self.table_key[slot] == 0
            self.table_key[slot[free]] = keys[todo[free]]
            won = free & (self.table_key[slot] == keys[todo])
            self.table_entry[slot[won]] = self.n + todo[won]
            todo, slot = todo[~won], (slot[~won] + 1) % self.slots
        self.n += len(keys)

    def encode(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each text), each text
        followed by ``end_id`` if one is given."""
        whole = {}
        if not self.by_piece:
            whole = dict(enumerate(texts))
        else:
            for i, t in enumerate(texts):
                if "\0" in t or any(a in t for a in self.added):
                    whole[i] = t
        joined = "\0".join("" if i in whole else t for i, t in enumerate(texts)) + "\0"
        code = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        kind = self.classes[np.minimum(code, 0xFFFF)]
        unsure = np.flatnonzero(kind == _UNSURE)
        if len(unsure):
            ends = np.flatnonzero(kind == _END)
            for i in np.unique(np.searchsorted(ends, unsure)):
                whole[int(i)] = texts[i]
            joined = "\0".join("" if i in whole else t for i, t in enumerate(texts)) + "\0"
            code = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
            kind = self.classes[np.minimum(code, 0xFFFF)]
        ids, counts = self._pieces(joined, code, kind, end_id)
        if whole:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            tail = [] if end_id is None else [end_id]
            for i, t in whole.items():
                parts[i] = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids + tail, dtype=np.uint32)
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)
        return ids, counts

    def _pieces(self, joined, code, kind, end_id):
        start = self.starts_of(code, kind)
        first = np.flatnonzero(start)
        last = np.append(first[1:], len(code))
        sums = np.empty(len(code) + 1, dtype=U64)
        sums[0] = 0
        from aerotrace.llm.textops import _power_tables
        powers, _ = _power_tables(len(code) + 1)
        np.cumsum(mix64(code.astype(U64) + U64(1)) * powers[:len(code)], out=sums[1:])
        keys = span_hash(sums, first, last) | U64(1)
        is_end = kind[first] == _END
        if self.n > self.most:
            self._clear()
        entry = self._find(keys)
        missing = np.flatnonzero((entry < 0) & ~is_end)
        if len(missing):
            new, at = np.unique(keys[missing], return_index=True)
            where = missing[at]
            self._grow(len(new))
            self._add(new, [joined[a:b] for a, b in zip(first[where].tolist(), last[where].tolist())])
            entry = self._find(keys)
        lens = np.where(is_end, 0 if end_id is None else 1, self.lens[entry] if self.n else 0)
        starts = self.starts[entry] if self.n else np.zeros(len(entry), np.int64)
        flat = self.flat
        if end_id is not None:
            starts = np.where(is_end, len(flat), starts)
            flat = np.append(flat, np.uint32(end_id))
        stop = np.cumsum(lens)
        ids = flat[np.arange(stop[-1]) + np.repeat(starts - stop + lens, lens)] if stop[-1] else np.zeros(0, np.uint32)
        total = stop[is_end]
        return ids, np.diff(np.concatenate([[0], total]))

    @staticmethod
    def starts_of(code: np.ndarray, kind: np.ndarray) -> np.ndarray:
        return piece_starts(code, kind)

    def _grow(self, extra: int) -> None:
        """Keep the table at most half full, whatever one slice brings."""
        if 2 * (self.n + extra) <= self.slots:
            return
        keys = self.table_key[self.table_key != 0]
        entries = self.table_entry[self.table_key != 0]
        while 2 * (self.n + extra) > self.slots:
            self.slots *= 2
        self.table_key, self.table_entry = np.zeros(self.slots, dtype=U64), np.zeros(self.slots, dtype=np.int32)
        todo, slot = np.arange(len(keys)), (keys % U64(self.slots)).astype(np.int64)
        while len(todo):
            free = self.table_key[slot] == 0
            self.table_key[slot[free]] = keys[todo[free]]
            won = free & (self.table_key[slot] == keys[todo])
            self.table_entry[slot[won]] = entries[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) % self.slots


def piece_starts(code: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin, for texts that each end with code point 0.

    The rule of byte-level models: contractions; runs of letters, numbers or
    other characters, each with one blank before it; white space, whose last
    character stays apart if a word follows."""
    before = np.concatenate([[_END], kind[:-1]]).astype(kind.dtype)
    after = np.concatenate([kind[1:], [_END]]).astype(kind.dtype)
    space = kind == _SPACE
    after_blank = np.concatenate([[False], code[:-1] == 0x20])
    word_next = (after != _SPACE) & (after != _END)
    start = np.where(space, (before != _SPACE) | word_next, (kind != before) & ~after_blank)
    start |= (kind == _END) | (before == _END)
    quote = np.flatnonzero(start & (code == 0x27))
    if len(quote):
        padded = np.concatenate([code, [0, 0, 0]])
        a, b = padded[quote + 1], padded[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        for q, n in ((quote[one], 1), (quote[two], 2)):
            start[q + 1] = False
            start[q + 1 + n] = True
    return start


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# -- length histogram ---------------------------------------------------------

def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``(id_col, n_tokens)`` per row; null texts have 0 tokens."""
    path = path or vocabulary_path()

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for start, end in text_slices(batch, "text", 1 << 21):
                part = batch.slice(start, end - start)
                _, counts = enc.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(counts)], names=["id", "n_tokens"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, n_tokens long").withColumnRenamed("id", id_col))


def length_histogram(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """Exact histogram of encoded lengths with its suffix sums, one row per
    length that occurs:

    n_tokens, n_docs, docs_at_least and tokens_at_least (documents that long
    or longer, and their tokens), share_below (of the documents that are
    shorter), truncated_total (tokens left if every document were cut to
    n_tokens).  ``context_totals`` answers any limit from these rows.

    Null and empty texts have length 0; repeated rows count each; null ids do
    not matter; an empty table gives an empty histogram.
    """
    source = docs.select(F.lit(None).cast("long").alias("_row"), F.col(text_col).alias("_text"))
    lengths = token_counts(source, "_row", "_text", path)
    histogram = lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs"))
    longer = running_sums(histogram, [F.col("n_tokens").desc()], {"docs_longer": "n_docs", "tokens_longer": "tokens"})
    total = longer.agg(F.sum("n_docs").alias("n"), F.sum("tokens").alias("t")).first()
    n, t = total["n"] or 0, total["t"] or 0
    at_least = F.col("docs_longer") + F.col("n_docs")
    return longer.select(
        "n_tokens", "n_docs", at_least.alias("docs_at_least"),
        (F.col("tokens_longer") + F.col("tokens")).alias("tokens_at_least"),
        ((F.lit(n) - at_least) / F.lit(n)).alias("share_below"),
        (F.lit(t) - F.col("tokens_longer") - F.col("tokens") + F.col("n_tokens") * at_least).alias("truncated_total"))


def context_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context, docs_over, truncated_total) for each context limit: the
    smallest length above a limit holds the suffix sums that answer it."""
    spark = histogram.sparkSession
    total = histogram.agg(F.max("tokens_at_least").alias("t")).first()["t"] or 0
    wanted = spark.createDataFrame([(int(x),) for x in limits], "context long")
    over = (F.broadcast(wanted).join(histogram, F.col("n_tokens") > F.col("context"), "left").groupBy("context")
            .agg(F.max("docs_at_least").alias("docs_over"), F.max("tokens_at_least").alias("tokens_over")))
    docs_over = F.coalesce("docs_over", F.lit(0))
    return over.select("context", docs_over.alias("docs_over"),
                       (F.lit(total) - F.coalesce("tokens_over", F.lit(0)) + F.col("context") * docs_over).alias("truncated_total"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length histogram of all documents."""
    return length_histogram(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# -- bit-packed files ---------------------------------------------------------

BLOCK = 4096  # ids per block; a multiple of 64
SEGMENT = 1 << 19  # ids per row of the file, about


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` low bits of each id, in order, little-endian, padded to 64 ids."""
    if bits == 16:
        padded = np.zeros(-(-len(ids) // 64) * 64, dtype="<u2")
        padded[:len(ids)] = ids
        return padded.tobytes()
    rows = -(-len(ids) // 64)
    padded = np.zeros(rows * 64, dtype=U64)
    padded[:len(ids)] = ids
    padded = padded.reshape(rows, 64)
    words = np.zeros((rows, bits), dtype=U64)
    for j in range(64):
        at, shift = divmod(j * bits, 64)
        words[:, at] |= padded[:, j] << U64(shift)
        if shift + bits > 64:
            words[:, at + 1] |= padded[:, j] >> U64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of a packed run, as uint32."""
    if bits == 16:
        return np.frombuffer(data, dtype="<u2", count=n).astype(np.uint32)
    words = np.frombuffer(data, dtype="<u8").reshape(-1, bits)
    out = np.empty((len(words), 64), dtype=np.uint32)
    mask = U64((1 << bits) - 1)
    for j in range(64):
        at, shift = divmod(j * bits, 64)
        value = words[:, at] >> U64(shift)
        if shift + bits > 64:
            value = value | words[:, at + 1] << U64(64 - shift)
        out[:, j] = value & mask
    return out.reshape(-1)[:n]


FILE_SCHEMA = ("part int, segment int, doc_ids array<long>, doc_lengths array<long>, n_ids long, bits int, "
               "block_offsets array<long>, payload binary")


def write_token_files(docs: DataFrame, target: str, id_col: str = "doc_id", text_col: str = "text",
                      path: str | None = None, end_id: int = END_ID) -> None:
    """Encode ``docs`` and write them to ``target`` in ascending id order.

    File format: Parquet rows of about half a million ids.  A row has the ids
    of its documents, their lengths, and all their tokens packed into the
    fewest bits the vocabulary needs; ``block_offsets`` gives the byte where
    each block of 4096 tokens begins.  Documents are not split over rows.
    """
    path = path or vocabulary_path()
    bits = max(encoder(path).vocabulary_size - 1, end_id).bit_length()
    bits = max(bits, 1)

    def run(batches):
        from pyspark import TaskContext
        enc, part, segment = encoder(path), TaskContext.get().partitionId(), 0
        doc_ids, lengths, ids, have = [], [], [], 0

        def row():
            flat = np.concatenate(ids)
            payload = pack_bits(flat, bits)
            blocks = np.arange(0, max(len(flat), 1), BLOCK) * bits // 8
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "segment": pa.array([segment], pa.int32()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "doc_lengths": pa.array([lengths], pa.list_(pa.int64())),
                "n_ids": pa.array([len(flat)], pa.int64()), "bits": pa.array([bits], pa.int32()),
                "block_offsets": pa.array([blocks], pa.list_(pa.int64())),
                "payload": pa.array([payload], pa.binary())})

        for batch in batches:
            for start, end in text_slices(batch, "text", 1 << 20):
                piece = batch.slice(start, end - start)
                flat, counts = enc.encode([t or "" for t in piece.column("text").to_pylist()], end_id)
                doc_ids += piece.column("id").to_pylist()
                lengths += counts.tolist()
                ids.append(flat)
                have += len(flat)
                if have >= SEGMENT:
                    yield row()
                    doc_ids, lengths, ids, have, segment = [], [], [], 0, segment + 1
        if doc_ids:
            yield row()

    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    by = [F.col("id").asc_nulls_last(), F.col("text")]
    # by the head of the text too, so that documents without an id spread
    ordered.repartitionByRange(by[0], F.substring("text", 1, 64)).sortWithinPartitions(*by).mapInArrow(run, FILE_SCHEMA).write.mode("overwrite").parquet(target)


def read_token_files(spark: SparkSession, target: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files;
    start counts the ids of all documents before it."""
    files = spark.read.schema(FILE_SCHEMA).parquet(target)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_bits(row["payload"], row["bits"], row["n_ids"]).astype("<u4")
                lengths = np.array(row["doc_lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["segment"], np.int32)),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                    names=["part", "segment", "doc_id", "place", "n_tokens", "ids_crc32"])

    docs = files.select("part", "segment", "doc_ids", "doc_lengths", "n_ids", "bits", "payload").mapInArrow(
        run, "part int, segment int, doc_id long, place long, n_tokens long, ids_crc32 long")
    index = running_sums(files.select("part", "segment", "n_ids"), [F.col("part"), F.col("segment")], {"first": "n_ids"})
    return docs.join(index.select("part", "segment", "first"), ["part", "segment"]).select(
        "doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def read_block(row, block: int) -> np.ndarray:
    """Ids of one block of a file row, without unpacking the others."""
    offsets, n = row["block_offsets"], min(BLOCK, row["n_ids"] - block * BLOCK)
    end = offsets[block + 1] if block + 1 < len(offsets) else len(row["payload"])
    return unpack_bits(bytes(row["payload"][offsets[block]:end]), row["bits"], n)


def token_table(docs: DataFrame, name: str = "tokens", **options) -> DataFrame:
    """Write the token files of ``docs`` under the shared folder and read them
    back per document.

    Null and empty texts have only the end id; null ids come last; rows that
    share an id keep a row each, ordered by text.  An empty table gives an
    empty result.  Other columns are ignored.
    """
    import uuid
    spark = docs.sparkSession
    target = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    write_token_files(docs, target, **options)
    return read_token_files(spark, target)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    return token_table(spark.read.parquet(f"{sf_dir}/documents.parquet"))
