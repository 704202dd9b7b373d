"""Removal of byte strings that an earlier document already has.

The suffix-array method of bucket-pointer refinement, spread over Spark:

1. Every position belongs to the bucket of its 20-byte gram.  Of each 50-byte
   string only the position with the smallest bucket number (its anchor) is
   kept, so equal strings keep the same anchor.  Buckets that a single
   document fills are finished; their positions are dropped.
2. The positions of the remaining buckets, with the bytes of the strings that
   they anchor, are refined by sorting on the bucket numbers of later offsets:
   (bucket at i, bucket at i + 20) gives the buckets of 40 bytes, and these in
   turn, at i and i + 10, the buckets of 50 bytes.
3. In each final bucket the smallest document id is the first owner; every
   string of a larger id is marked, and a document loses the bytes that marked
   strings cover.

Exact copies count as one text, that of their smallest id; the other copies
repeat it whole.  Positions travel in packed arrays, one row per task slice and
group of buckets.  A slice sends one position per bucket (and per equal surrounding) at
most, and settles its other copies itself, so a bucket that a third of the
documents share costs its group one row entry per slice.  At the edge of a
shared passage every document has surroundings of its own; a group with many
documents is therefore cut by a second hash, that of the whole string, and its
strings travel as hashes.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerotrace.llm.textops import U64, mix64, prefix_hash, span_hash, text_buffer, text_slices
from aerotrace.session import stage_table

LENGTH = 50
GRAM = 20
SLICE_BYTES = 2 << 20
GROUP_BYTES = 3 << 20  # text bytes per group of buckets, which sets the number of groups
HASH_BLOCK = 1 << 18  # positions hashed at a time: the passes' arrays are this long, not as long as the text
HOT_ENTRIES = 1 << 18  # buckets of documents in a group from which on it is cut, and strings in each part


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram at each position.  A span's hash does not depend on
    where it lies, so blocks give the same numbers as the whole."""
    out = np.empty(max(0, len(data) - gram + 1), dtype=U64)
    for a in range(0, len(out), HASH_BLOCK):
        at = np.arange(min(HASH_BLOCK, len(out) - a))
        out[a:a + len(at)] = span_hash(prefix_hash(data[a:a + len(at) + gram - 1]), at, at + gram)
    return out


def _numbering(values: np.ndarray) -> np.ndarray:
    """Rank of each value among the distinct values."""
    order = np.argsort(values)
    lead = np.zeros(len(values), dtype=bool)
    lead[1:] = np.diff(values[order]) != 0
    out = np.empty(len(values), dtype=np.int32)
    out[order] = np.cumsum(lead, dtype=np.int32)
    return out


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(text, first string start, last string start, anchor bucket) of the runs
    of consecutive strings with one anchor bucket; positions in ``data``."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, np.zeros(0, U64)
    anchor = _sliding_min(gram_hashes(data, gram), length - gram + 1)
    starts, ends = offsets[:-1], offsets[1:]
    inside = np.ones(len(data), dtype=bool)
    for short in range(1, length):  # bytes that the string still has in its text
        at = ends - short
        inside[at[at >= starts]] = False
    inside = inside[:len(anchor)]
    change = np.ones(len(anchor), dtype=bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    change[starts[starts < len(anchor)]] = True
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(anchor)) - 1
    ok = inside[first]
    first, last = first[ok], last[ok]
    return np.searchsorted(offsets, first, "right") - 1, first, last, anchor[first]


def _split(bucket: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, 32-bit number inside it) of bucket hashes; small numbers are
    used up by the choice of anchors, so the low bits are taken."""
    return (bucket % U64(groups)).astype(np.int64), ((bucket // U64(groups)) & U64(0xFFFFFFFF)).astype(np.uint32)


def _slice_number(part: int, tasks: int) -> int:
    """Salt for rows that need not meet: so many tasks share one."""
    from pyspark import TaskContext
    return TaskContext.get().partitionId() // tasks * 64 + part % 64


def _binary(parts) -> pa.Array:
    return pa.array(list(parts), pa.binary())


def _anchors(docs: DataFrame, groups: int, length: int, gram: int) -> DataFrame:
    """Rows (grp, row, numbers, owners): per slice and group, one entry for each
    bucket and its owner (an index into ``row``); grp < 0: buckets that
    several documents of the slice share, already known as repeated."""

    def run(batches):
        part = 0
        for batch in batches:
            for start, end in text_slices(batch, "text", SLICE_BYTES):
                piece = batch.slice(start, end - start)
                key = np.asarray(piece.column("row"))
                data, offsets = text_buffer(piece.column("text"))
                owner, _, _, bucket = anchor_runs(data, offsets, length, gram)
                grp, number = _split(bucket, groups)
                whole = (grp.astype(U64) << U64(32)) | number.astype(U64)
                text = np.unique(key, return_index=True, return_inverse=True)
                text = text[1][text[2]][owner]  # exact copies in the slice are one document
                order = np.lexsort((text, whole))
                whole, text = whole[order], text[order]
                new = np.ones(len(whole), dtype=bool)
                new[1:] = (whole[1:] != whole[:-1]) | (text[1:] != text[:-1])
                whole, text = whole[new], text[new]  # one entry per bucket and document
                lead = np.ones(len(whole), dtype=bool)
                lead[1:] = whole[1:] != whole[:-1]
                run_id = np.cumsum(lead) - 1
                shared = np.bincount(run_id, minlength=1)[run_id] > 1 if len(whole) else lead
                part += 1
                for own, negative in ((lead, False), (shared, True)):
                    w, t = whole[own], text[own]
                    g = (w >> U64(32)).astype(np.int64)
                    cuts = np.flatnonzero(np.diff(g)) + 1
                    at = np.concatenate([[0], cuts, [len(g)]]) if len(g) else np.zeros(1, int)
                    rows = [(int(g[a]), a, b) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                    if not rows:
                        continue
                    owners, rowkeys = [], []
                    for _, a, b in rows:
                        who, place = np.unique(t[a:b], return_inverse=True)
                        rowkeys.append(key[who].astype("<i8").tobytes())
                        owners.append(place.astype("<u2").tobytes())
                    yield pa.RecordBatch.from_arrays([
                        pa.array([-1 - x if negative else x for x, _, _ in rows], pa.int64()),
                        pa.array([_slice_number(part, 128) if negative else 0] * len(rows), pa.int32()),
                        _binary(rowkeys), _binary((w[a:b] & U64(0xFFFFFFFF)).astype("<u4").tobytes() for _, a, b in rows),
                        _binary(owners)], names=["grp", "salt", "row", "numbers", "owners"])

    return docs.mapInArrow(run, "grp long, salt int, row binary, numbers binary, owners binary")


def _repeated(anchors: DataFrame) -> DataFrame:
    """(row, grp, numbers): the buckets of each document that more than one
    document fills."""

    def settle(table: pa.Table) -> pa.Table:
        grp = table.column("grp")[0].as_py()
        rows, numbers, owner = [], [], []
        for r, n, o in zip(*(table.column(c).to_pylist() for c in ("row", "numbers", "owners"))):
            key = np.frombuffer(r, "<i8")
            rows.append(key[np.frombuffer(o, "<u2")])
            numbers.append(np.frombuffer(n, "<u4"))
        row, number = np.concatenate(rows), np.concatenate(numbers)
        if grp >= 0:
            order = np.lexsort((row, number))
            row, number = row[order], number[order]
            new = np.ones(len(number), dtype=bool)
            new[1:] = (number[1:] != number[:-1]) | (row[1:] != row[:-1])
            row, number = row[new], number[new]
            same = np.zeros(len(number), dtype=bool)
            same[1:] = number[1:] == number[:-1]
            same[:-1] |= number[1:] == number[:-1]
            row, number = row[same], number[same]
        order = np.lexsort((number, row))
        row, number = row[order], number[order]
        cuts = np.flatnonzero(np.diff(row)) + 1
        at = np.concatenate([[0], cuts, [len(row)]]) if len(row) else np.zeros(1, int)
        return pa.table({
            "row": pa.array(row[at[:-1]] if len(row) else [], pa.int64()),
            "grp": pa.array([grp if grp >= 0 else -1 - grp] * (len(at) - 1), pa.int64()),
            "numbers": _binary(number[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist()))})

    return anchors.groupBy("grp", "salt").applyInArrow(settle, "row long, grp long, numbers binary")


def _hot_groups(repeated: DataFrame, length: int, gram: int) -> dict[int, int]:
    """Parts of each group that holds buckets of many documents; there are at
    most as many such groups as HOT_ENTRIES goes into all entries."""
    entries = repeated.groupBy("grp").agg(F.sum(F.octet_length("numbers") / 4).cast("long").alias("n")).where(F.col("n") > HOT_ENTRIES)
    return {r["grp"]: math.ceil(r["n"] * (length - gram + 1) / HOT_ENTRIES) for r in entries.collect()}


def _string_runs(record: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of consecutive positions of a record."""
    cut = np.ones(len(at), dtype=bool)
    cut[1:] = (np.diff(at) != 1) | (record[1:] != record[:-1])
    lead = np.flatnonzero(cut)
    return lead, np.append(lead[1:], len(at))[:len(lead)] - 1


def _string_keys(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the string at each position, one of them from its buckets."""
    sums = prefix_hash(data)
    key = np.zeros(len(at), dtype=U64)
    for offset in (0, gram, length - gram):
        key = mix64(key * U64(0x9E3779B97F4A7C15) + span_hash(sums, at + offset, at + offset + gram))
    return key, span_hash(sums, at, at + length)


def _surroundings(docs: DataFrame, groups: int, length: int, gram: int, hot: dict[int, int]) -> DataFrame:
    """Rows (grp, salt, ids, rows, starts, sizes, bytes): per slice and group,
    the strings' bytes around each repeated anchor.  Of equal surroundings in
    one slice only those of the smallest id are sent; the others repeat it
    whole and come as finished ranges with grp < 0.  In a hot group the same
    holds for single strings, which come as hash pairs with salt > 0 by hash."""
    hot_groups = np.array(sorted(hot), dtype=np.int64)
    hot_parts = np.array([hot[g] for g in sorted(hot)], dtype=np.int64)

    def run(batches):
        part = 0
        for batch in batches:
            for start, end in text_slices(batch, "text", SLICE_BYTES):
                piece = batch.slice(start, end - start)
                ids, key = np.asarray(piece.column("id")), np.asarray(piece.column("row"))
                data, offsets = text_buffer(piece.column("text"))
                text, first, last, bucket = anchor_runs(data, offsets, length, gram)
                grp, number = _split(bucket, groups)
                whole = (grp.astype(U64) << U64(32)) | number.astype(U64)
                known = piece.column("known").to_pylist()
                keep = np.zeros(len(text), dtype=bool)
                bounds = np.searchsorted(text, np.arange(len(known) + 1))
                for i, cells in enumerate(known):
                    want = np.concatenate([(U64(c["grp"]) << U64(32)) | np.frombuffer(c["numbers"], "<u4").astype(U64) for c in cells])
                    keep[bounds[i]:bounds[i + 1]] = np.isin(whole[bounds[i]:bounds[i + 1]], want)
                text, first, last, grp = text[keep], first[keep], last[keep], grp[keep]
                if not len(text):
                    continue
                same = span_hash(prefix_hash(data), first, last + length)
                order = np.lexsort((ids[text], same))
                text, first, last, grp, same = text[order], first[order], last[order], grp[order], same[order]
                lead = np.ones(len(same), dtype=bool)
                lead[1:] = same[1:] != same[:-1]
                lowest = ids[text][lead][np.cumsum(lead) - 1]
                sent = ids[text] == lowest
                part += 1
                salt = _slice_number(part, 16)

                def rows(grp, salt, text, start, size, content, own_ids=ids, own_key=key, offsets=offsets):
                    return pa.RecordBatch.from_arrays([
                        pa.array([int(grp)], pa.int64()), pa.array([int(salt)], pa.int32()),
                        _binary([own_ids[text].astype("<i8").tobytes()]), _binary([own_key[text].astype("<i8").tobytes()]),
                        _binary([(start - offsets[text]).astype("<i4").tobytes()]), _binary([size.astype("<i4").tobytes()]), _binary([content])],
                        names=["grp", "salt", "ids", "rows", "starts", "sizes", "bytes"])

                is_hot = np.isin(grp, hot_groups)
                own = np.flatnonzero(~sent)
                if len(own):
                    yield rows(-1, salt, text[own], first[own], last[own] + length - first[own], b"")
                own = np.flatnonzero(sent & ~is_hot)
                own = own[np.argsort(grp[own], kind="stable")]
                for idx in np.split(own, np.flatnonzero(np.diff(grp[own])) + 1) if len(own) else []:
                    size = last[idx] + length - first[idx]
                    content = zlib.compress(b"".join(data[a:a + n].tobytes() for a, n in zip(first[idx].tolist(), size.tolist())), 1)
                    yield rows(grp[idx[0]], 0, text[idx], first[idx], size, content)
                own = np.flatnonzero(sent & is_hot)
                if not len(own):
                    continue
                count = last[own] - first[own] + 1
                record = np.repeat(own, count)
                at = first[record] + np.arange(len(record)) - np.repeat(np.cumsum(count) - count, count)
                key1, key2 = _string_keys(data, at, length, gram)
                order = np.lexsort((ids[text[record]], key2, key1))
                lead = np.ones(len(order), dtype=bool)
                lead[1:] = (np.diff(key1[order]) != 0) | (np.diff(key2[order]) != 0)
                lowest = np.empty(len(order), dtype=np.int64)
                lowest[order] = ids[text[record]][order][lead][np.cumsum(lead) - 1]
                sent = ids[text[record]] == lowest
                done = np.flatnonzero(~sent)
                if len(done):
                    a, b = _string_runs(record[done], at[done])
                    a, b = done[a], done[b]
                    yield rows(-1, salt, text[record[a]], at[a], at[b] + length - at[a], b"")
                hot_at = np.searchsorted(hot_groups, grp[record])
                cell = key1 % hot_parts[hot_at].astype(U64)
                o = np.flatnonzero(sent)
                o = o[np.lexsort((cell[o], hot_at[o]))]
                cuts = np.flatnonzero((np.diff(hot_at[o]) != 0) | (np.diff(cell[o]) != 0)) + 1
                for idx in np.split(o, cuts):
                    pairs = np.stack([key1[idx], key2[idx]], axis=1).astype("<u8")
                    yield rows(grp[record[idx[0]]], 1 + int(cell[idx[0]]), text[record[idx]], at[idx],
                               np.full(len(idx), length), pairs.tobytes())

    return docs.mapInArrow(run, "grp long, salt int, ids binary, rows binary, starts binary, sizes binary, bytes binary")


def refine(numbers: np.ndarray, later: int, valid: np.ndarray) -> np.ndarray:
    """Bucket numbers of longer strings from those of shorter ones: positions
    are sorted by (own bucket, bucket at ``later`` bytes further on) and
    numbered anew.  Positions where that offset is not valid get -1."""
    at = np.flatnonzero(valid)
    pair = numbers[at].astype(U64)
    pair <<= U64(32)
    pair |= numbers[at + later].astype(U64)
    out = np.full(len(numbers), -1, dtype=np.int32)
    out[at] = _numbering(pair)
    return out


def _ranges(surroundings: DataFrame, length: int, gram: int) -> DataFrame:
    """(row, ranges): byte ranges of each document that marked strings cover."""

    def settle(table: pa.Table) -> pa.Table:
        cat = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in table.column(c).to_pylist()]).astype(np.int64)
        ids, rows, starts, sizes = cat("ids", "<i8"), cat("rows", "<i8"), cat("starts", "<i4"), cat("sizes", "<i4")
        if table.column("grp")[0].as_py() < 0:
            begin, end, row = starts, starts + sizes, rows
        elif table.column("salt")[0].as_py() > 0:
            pairs = cat("bytes", "<i8").reshape(-1, 2)
            order = np.lexsort((ids, pairs[:, 1], pairs[:, 0]))
            lead = np.ones(len(order), dtype=bool)
            lead[1:] = (pairs[order[1:]] != pairs[order[:-1]]).any(axis=1)
            marked = order[ids[order] > ids[order][lead][np.cumsum(lead) - 1]]
            marked = marked[np.lexsort((starts[marked], rows[marked]))]
            a, b = _string_runs(rows[marked], starts[marked])
            begin, end, row = starts[marked[a]], starts[marked[b]] + length, rows[marked[a]]
        else:
            data = np.frombuffer(b"".join(zlib.decompress(x) for x in table.column("bytes").to_pylist()), np.uint8)
            stop = np.cumsum(sizes)
            hashes = gram_hashes(data, gram)
            record = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            left = np.repeat(stop.astype(np.int32), sizes)
            left -= np.arange(len(data), dtype=np.int32)  # bytes up to the end of the record
            numbers = np.full(len(data), -1, dtype=np.int32)
            good = left[:len(hashes)] >= gram
            numbers[:len(hashes)][good] = _numbering(hashes[good])
            del hashes, good
            numbers = refine(numbers, gram, left >= 2 * gram)
            numbers = refine(numbers, length - 2 * gram, left >= length)
            at = np.flatnonzero(left >= length)
            bucket, owner = numbers[at], ids[record[at]]
            first_owner = np.full(int(bucket.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(first_owner, bucket, owner)
            at = at[first_owner[bucket] < owner]
            lead, tail = _string_runs(record[at], at)
            r = record[at[lead]]
            shift = starts[r] - (stop[r] - sizes[r])
            begin, end, row = at[lead] + shift, at[tail] + shift + length, rows[r]
        order = np.lexsort((begin, row))
        begin, end, row = begin[order], end[order], row[order]
        cuts = np.flatnonzero(np.diff(row)) + 1
        at = np.concatenate([[0], cuts, [len(row)]]) if len(row) else np.zeros(1, int)
        pairs = np.stack([begin, end], axis=1).astype("<i4")
        return pa.table({"row": pa.array(row[at[:-1]] if len(row) else [], pa.int64()),
                         "ranges": _binary(pairs[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist()))})

    return surroundings.groupBy("grp", "salt").applyInArrow(settle, "row long, ranges binary")


def merge_ranges(pairs: np.ndarray) -> np.ndarray:
    """Union of (begin, end) ranges as maximal disjoint ones, in order."""
    if not len(pairs):
        return pairs.reshape(0, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    lead = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] > reach[:-1]]))
    return np.stack([pairs[lead, 0], reach[np.append(lead[1:], len(pairs)) - 1]], axis=1)


def cut_text(raw: bytes, ranges: np.ndarray) -> bytes:
    out, at = [], 0
    for a, b in ranges.tolist():
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    gram: int = GRAM) -> DataFrame:
    """``docs`` with what to remove: (id, text, copy, ranges).  ``copy`` marks a
    copy of a text with a smaller id; ranges is a list of packed (begin, end)
    byte pairs, null if there is none.

    ``row`` names a text and ``place`` a text with its id, both by 64-bit
    hashes.  Texts are exchanged by place, so copies spread, and this one
    exchange serves both the surroundings and the result.
    """
    if not 2 * gram < length <= 3 * gram:
        raise ValueError("the string length must be over two grams and at most three")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumns(
        {"row": F.xxhash64("text"), "place": F.xxhash64("id", "text")})
    fits = F.col("id").isNotNull() & (F.octet_length("text") >= length)
    names = stage_table(source.where(fits).select("id", "row", "place", F.octet_length("text").cast("long").alias("size"))
                        .distinct(), "substring-names")
    total = names.agg(F.sum("size")).first()[0] or 0
    groups = max(64, math.ceil(total / GROUP_BYTES))
    firsts = stage_table(names.groupBy("row").agg(F.min("id").alias("first")), "substring-firsts")
    names = stage_table(names.join(firsts, "row").select("row", "place", (F.col("id") > F.col("first")).alias("copy")), "substring-places")
    first_places = names.where("NOT copy").select("row", "place")

    repeated = stage_table(_repeated(_anchors(source.where(fits).select("row", "text"), groups, length, gram)), "substring-anchors")
    known = repeated.groupBy("row").agg(F.collect_list(F.struct("grp", "numbers")).alias("known"))
    known = known.join(first_places, "row").select("place", "known")
    texts = source.select("id", "text", "place")
    around = texts.join(known, "place").select("id", F.col("place").alias("row"), "text", "known")
    ranges = _ranges(_surroundings(around, groups, length, gram, _hot_groups(repeated, length, gram)), length, gram)
    ranges = ranges.groupBy(F.col("row").alias("place")).agg(F.collect_list("ranges").alias("ranges"), F.lit(False).alias("copy"))
    copies = names.where("copy").select("place", F.lit(None).cast("array<binary>").alias("ranges"), F.lit(True).alias("copy"))
    return texts.join(ranges.unionByName(copies), "place", "left").select("id", "text", "copy", "ranges")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: (id_col, n_bytes, n_removed, n_spans,
    kept_sha256, kept): the text without each byte that lies in a ``length``-byte
    string which also starts in a document with a smaller id.

    Texts are UTF-8 bytes; strings never cross documents, may overlap, and are
    judged on the input.  Null texts are empty; shorter texts stay whole.  A
    document without an id stays whole and is nobody's earlier document.  Rows
    that share an id never remove from each other; exact repeats of a row are
    all returned.  An empty table gives an empty result; other columns of
    ``docs`` are ignored.
    """

    def run(batches):
        for batch in batches:
            cells, copies = batch.column("ranges").to_pylist(), batch.column("copy").to_pylist()
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            out = []
            for raw, parts, copy in zip(texts, cells, copies):
                parts = [np.array([0, len(raw)], "<i4").tobytes()] if copy else parts
                pairs = np.frombuffer(b"".join(parts or ()), "<i4").reshape(-1, 2).astype(np.int64)
                merged = merge_ranges(pairs)
                kept = cut_text(raw, merged)
                out.append((len(raw), len(raw) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept))
            n, removed, spans, digest, kept = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return repeated_ranges(docs, id_col, text_col, length, gram).mapInArrow(
        run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").withColumnRenamed("id", id_col)


def op8_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 50-byte strings removed from all documents."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
