"""Near-duplicate grouping by SuperMinHash signatures.

Every element (word shingle) of a text draws one random permutation of the
``m`` signature positions and gives its j-th position the value ``j + u_j``;
a position keeps its smallest value.  The ranks of one element are thus
correlated, which lowers the variance against independent hash functions, and
a text can stop after step ``j`` once every position holds less than
``j + 1``: later steps only give larger values.

The steps after the signatures:

1. texts with the same word sequence form a class, represented by one row;
2. signatures are cut into bands; classes that agree on a band share a bucket;
3. links are confirmed on full shingle sets, in three rounds: each class
   against the smallest bucket pivot, then against the pivots of its other
   buckets that are in another component, then every pair of a bucket that
   still lies in different components.  Bucket members are compared in blocks
   on their signatures first, so no task holds a bucket whole and the
   (mostly hopeless) pairs are not emitted;
4. union of the confirmed links into components after each round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerotrace.llm.components import labels_of_others
from aerotrace.llm.textops import U64, Words, distinct_sorted, mix64, text_slices
from aerotrace.session import drop_staged, stage_table

#: Signature length and rows per band.  A pair of similarity 0.8 shares no
#: band with probability (1 - 0.8^4)^24 < 4e-6.
SIZE, ROWS = 96, 4
#: The last round compares longer signatures first.  A pair of similarity 0.8
#: agrees on 0.8 of them on average, with deviation 0.018 at most; it falls
#: below the least share with probability < 2e-5.
LONG_SIZE, LEAST_AGREEMENT = 512, 0.725
#: Rows that a task takes at least, on average, by what they hold: a class with
#: its bands; node and bucket; a text, a set or a pair of sets to compare; a
#: set to draw a long signature from.
CLASS_ROWS, MEMBER_ROWS, SET_ROWS, LONG_ROWS = 1 << 12, 1 << 16, 1 << 9, 1 << 8
#: Bytes of permutations held at once (twice that while texts drop out).
ORDER_BYTES = 8 << 20


def super_minhash(values: np.ndarray, offsets: np.ndarray, m: int = SIZE) -> np.ndarray:
    """Signatures (texts x m, float64) of sets given as flat 64-bit elements
    and per-text offsets; an empty set keeps ``inf`` everywhere.

    The permutations of ORDER_BYTES are held at once, whatever the size of a
    set: a larger one is cut into parts, and the signature of a union is the
    least of those of its parts, position by position."""
    step = max(1, ORDER_BYTES // (m * _order_type(m)().itemsize))
    counts = np.diff(offsets)
    parts = np.maximum(-(-counts // step), 1)
    text = np.repeat(np.arange(len(counts)), parts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    bounds = np.append(offsets[text] + counts[text] * nth // parts[text], offsets[-1])
    signature = np.full((len(counts), m), np.inf)
    at = 0
    while at < len(text):
        end = max(int(np.searchsorted(bounds, bounds[at] + step, side="right")) - 1, at + 1)
        part = _signatures_of_parts(values[bounds[at]:bounds[end]], bounds[at:end + 1] - bounds[at], m)
        # only the first and the last part can belong to a text that is cut
        for i in {0, end - at - 1}:
            np.minimum(signature[text[at + i]], part[i], out=signature[text[at + i]])
        signature[text[at + 1:end - 1]] = part[1:-1]
        at = end
    return signature


def _order_type(m: int):
    return np.uint8 if m <= 256 else np.uint16


def _signatures_of_parts(values: np.ndarray, offsets: np.ndarray, m: int) -> np.ndarray:
    n = len(offsets) - 1
    counts = np.diff(offsets)
    signature = np.full(n * m, np.inf)
    text = np.repeat(np.arange(n), counts)
    element = values
    order = None  # per element: the permutation so far, once a second step is needed
    for j in range(m):
        draw = mix64(element + U64((2 * j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        other = mix64(draw ^ U64(0xD6E8FEB86659FD93))
        rank = j + (draw >> U64(11)).astype(np.float64) / 2.0**53
        pick = j + ((other >> U64(32)) * U64(m - j) >> U64(32)).astype(np.int64)
        if order is None:
            position = pick
        else:
            row = np.arange(len(element))
            position = order[row, pick].astype(np.int64)
            order[row, pick] = order[:, j]
        np.minimum.at(signature, text * m + position, rank)
        worst = signature.reshape(n, m).max(axis=1)
        going = (worst > j + 1) & (counts > 0)
        if not going.any():
            break
        keep = going[text]
        if order is None:
            element, text, position = element[keep], text[keep], position[keep]
            order = np.tile(np.arange(m, dtype=_order_type(m)), (len(element), 1))
            order[np.arange(len(element)), position] = 0
        elif not keep.all():
            element, text, order = element[keep], text[keep], order[keep]
    return signature.reshape(n, m)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


SIGNATURE_SCHEMA = "id long, t1 long, t2 long, n_shingles long, key1 long, key2 long, bands array<long>"
#: Text bytes and rows handled at once.  A worker keeps much of what it once
#: took, and all later steps of the job share the executor with it.
PIECE_BYTES, PIECE_ROWS = 1 << 18, 1 << 12


def named_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, t1, t2, text): a text is named by a 128-bit hash, so that rows
    which share an id, or have none, are told apart."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("t1"),
                       F.xxhash64(F.lit("text"), text).alias("t2"), text.alias("text"))


def signatures(texts: DataFrame, k: int, m: int = SIZE, rows: int = ROWS) -> DataFrame:
    """One row per row of ``texts`` (``named_texts``): its name, set size,
    128-bit key of the word sequence and band hashes (empty without words)."""

    def run(batches):
        for batch in batches:
            for start, end in text_slices(batch, "text", PIECE_BYTES, PIECE_ROWS):
                part = batch.slice(start, end - start)
                words = Words(part.column("text"))
                shingle, offsets = words.shingles(k)
                seq = words.shingles(1)[0]
                place = np.arange(len(seq)) - np.repeat(words.offsets[:-1], words.counts)
                keys = []
                for salt in (0x51ED270B, 0xA24BAED4):
                    mixed = mix64(seq + mix64(place.astype(U64) + U64(salt)))
                    total = np.concatenate([np.zeros(1, U64), np.cumsum(mixed)])
                    keys.append(mix64(total[words.offsets[1:]] - total[words.offsets[:-1]] + words.counts.astype(U64)))
                sets, set_offsets = distinct_sorted(shingle, offsets)
                sig = super_minhash(sets, set_offsets, m)
                bits = mix64(sig.view(U64).reshape(len(sig), m))
                has = words.counts > 0
                n_bands = m // rows
                band = np.zeros((len(sig), n_bands), dtype=U64)
                for r in range(rows):
                    band = mix64(band * U64(0x9E3779B97F4A7C15) + bits[:, r:n_bands * rows:rows])
                flat = _signed(band[has].reshape(-1))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(has, n_bands, 0))]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([
                    *[part.column(c) for c in ("id", "t1", "t2")], pa.array(np.diff(set_offsets)), pa.array(_signed(keys[0])),
                    pa.array(_signed(keys[1])), lists], names=["id", "t1", "t2", "n_shingles", "key1", "key2", "bands"])

    return texts.mapInArrow(run, SIGNATURE_SCHEMA)


def shingle_sets(texts: DataFrame, k: int) -> DataFrame:
    """``texts(node, text)`` -> ``(node, shingles)``: the sorted distinct hashes."""

    def run(batches):
        for batch in batches:
            for start, end in text_slices(batch, "text", PIECE_BYTES, PIECE_ROWS):
                part = batch.slice(start, end - start)
                words = Words(part.column("text"))
                sets, offsets = distinct_sorted(*words.shingles(k))
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(_signed(sets)))],
                    names=["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles array<long>")


def long_signatures(sets: DataFrame, m: int = LONG_SIZE) -> DataFrame:
    """``sets(node, shingles, all)`` -> ``(node, signature, all)``, one byte a
    position; ``all`` is the node's buckets with their bands."""

    def run(batches):
        for batch in batches:
            lists = batch.column("shingles")
            offsets = np.asarray(lists.offsets).astype(np.int64)
            start = 0
            while start < len(lists):
                end = int(np.searchsorted(offsets, offsets[start] + (1 << 16), side="right")) - 1
                end = min(max(end, start + 1), start + (PIECE_ROWS >> 2), len(lists))
                values = np.asarray(lists.values)[offsets[start]:offsets[end]].view(U64)
                bits = mix64(super_minhash(values, offsets[start:end + 1] - offsets[start], m).view(U64))
                small = (bits >> U64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(start, end - start), pa.array([x.tobytes() for x in small], pa.binary()),
                     batch.column("all").slice(start, end - start)],
                    names=["node", "signature", "all"])
                start = end

    return sets.mapInArrow(run, "node long, signature binary, all array<struct<band:int,bucket:long>>")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets have 100 * shared >= percent * union."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - F.col("shared")
    return (pairs.join(b, "b").join(a, "a").withColumn("shared", shared)
            .where(100 * F.col("shared") >= percent * union).select("a", "b"))


def _block_pairs(members: DataFrame, block: int = 512) -> DataFrame:
    """Pairs ``(a, b)`` of one bucket that lie in different components and
    agree on enough signature positions.  ``members``: bucket, band, node,
    component, signature, minor (true outside the bucket's largest component),
    all (the node's buckets with their bands), n and n_minor (members of the
    bucket, and minor ones).  A bucket is cut into blocks by a hash of the
    node; every block of minor members meets every block of the bucket, so a
    task holds two blocks at most, and members of the largest component never
    meet each other.  A pair that shares several buckets comes
    out of the first of them only."""
    split = members.withColumns({"blocks": F.ceil(F.col("n") / block).cast("int"),
                                 "minor_blocks": F.ceil(F.col("n_minor") / block).cast("int")})
    of = lambda n: f"pmod(xxhash64(node), {n})"
    own = f"transform(sequence(0, blocks - 1), j -> struct(int({of('minor_blocks')}) AS i, j AS j, true AS own))"
    met = f"transform(sequence(0, minor_blocks - 1), i -> struct(i AS i, int({of('blocks')}) AS j, false AS own))"
    cells = split.withColumn("cell", F.explode(F.expr(f"concat(if(minor, {own}, array()), {met})"))).select(
        "bucket", "band", "node", "component", "minor", "signature", "all", "cell.i", "cell.j", "cell.own")

    def meet(table: pa.Table) -> pa.Table:
        own = np.asarray(table.column("own"))
        ids, comp = np.asarray(table.column("node")), np.asarray(table.column("component"))
        sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
        lists = table.column("all").combine_chunks()
        flat, ends = lists.flatten(), np.asarray(lists.offsets)
        row = np.repeat(np.arange(len(ids)), np.diff(ends))
        bands = np.asarray(flat.field("band"))
        held = np.zeros((len(ids), int(bands.max()) + 1), dtype=np.int64)
        held[row, bands] = np.asarray(flat.field("bucket"))
        here, minor = table.column("band")[0].as_py(), np.asarray(table.column("minor"))
        rest = np.flatnonzero(~own)
        out_a, out_b = [], []
        for x in np.flatnonzero(own):
            agree = (sig[rest] == sig[x]).sum(axis=1)
            hit = rest[(agree >= LEAST_AGREEMENT * sig.shape[1]) & (comp[rest] != comp[x])]
            earlier = (held[hit, :here] == held[x, :here]) & (held[x, :here] != 0)
            hit = hit[~earlier.any(axis=1) & (~minor[hit] | (ids[hit] > ids[x]))]
            out_a.append(np.minimum(ids[hit], ids[x]))
            out_b.append(np.maximum(ids[hit], ids[x]))
        cat = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
        return pa.table({"a": cat(out_a), "b": cat(out_b)})

    # dealt by block: left to itself Spark keeps a bucket's rows where the join on the bucket has put them
    return cells.repartition("bucket", "i", "j").groupBy("bucket", "i", "j").applyInArrow(meet, "a long, b long")


def _classes(rows: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(key1, key2, rep, component) of each word sequence in ``rows``
    (``signatures`` with words): rep is its smallest row name (no_id, id, t1,
    t2), ids first, and component the same value for classes that are linked.

    A class goes by a number of its own through buckets, sets and links, so it
    does not matter which ids its rows have.  Numbers follow the order of the
    names: the pivot of a bucket is its smallest name, more often the text that
    the others were copied from than any other member."""
    n = rows.count()
    files = lambda count, each: 1 + count // each
    # rows of a class have the same bands, so these do not change which name is smallest
    name = F.struct(F.col("id").isNull().alias("no_id"), "id", "t1", "t2", "bands")
    order = ["rep.no_id", "rep.id", "rep.t1", "rep.t2"]
    classes = rows.groupBy("key1", "key2").agg(F.min(name).alias("rep")).repartitionByRange(*order).sortWithinPartitions(*order)
    classes = stage_table(classes.select("key1", "key2", F.struct(*order).alias("rep"), "rep.bands",
                                         F.monotonically_increasing_id().alias("node")), "minhash-classes", files(n, CLASS_ROWS))

    exploded = classes.select("node", F.posexplode("bands").alias("band", "value")).select(
        "node", "band", F.xxhash64("band", "value").alias("bucket"))
    n_members = n * (SIZE // ROWS)
    buckets = stage_table(exploded.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
                          .where("pivot < last").select("bucket", "pivot"), "minhash-buckets", files(n_members, MEMBER_ROWS))
    members = stage_table(exploded.join(buckets, "bucket"), "minhash-members", files(n_members, MEMBER_ROWS))
    pivots = stage_table(members.groupBy("node").agg(F.collect_set("pivot").alias("pivots")), "minhash-pivots", files(n, CLASS_ROWS))
    n_active, n_stars = pivots.agg(F.count("*"), F.coalesce(F.sum(F.size("pivots")), F.lit(0))).first()
    active = classes.select("node", "rep.id", "rep.t1", "rep.t2").join(pivots.select("node"), "node")
    same = [texts["id"].eqNullSafe(active["id"]), texts["t1"] == active["t1"], texts["t2"] == active["t2"]]
    chosen = texts.join(active, same).select("node", "text").dropDuplicates(["node"]).coalesce(files(n_active, SET_ROWS))
    sets = stage_table(shingle_sets(chosen, k), "minhash-sets")

    first = pivots.select(F.array_min("pivots").alias("a"), F.col("node").alias("b")).where("a < b")
    links = stage_table(_confirm(first, sets, percent), "minhash-links", files(n_active, SET_ROWS))
    component = labels_of_others(links, n_active)

    def labelled(table: DataFrame, key: str, name: str, labels: DataFrame) -> DataFrame:
        return table.join(labels.select(F.col("node").alias(key), F.col("component").alias("_c")), key, "left").withColumn(
            name, F.coalesce("_c", key)).drop("_c")

    stars = pivots.select(F.explode("pivots").alias("a"), F.col("node").alias("b")).where("a < b")
    stars = labelled(labelled(stars, "b", "cb", component), "a", "ca", component).where("ca <> cb").select("a", "b")
    more = stage_table(_confirm(stars, sets, percent).unionByName(links), "minhash-links", files(n_stars, SET_ROWS))
    drop_staged(links, component)
    links, component = more, labels_of_others(more, n_active + n_stars)

    member = labelled(members.select("bucket", "band", "node"), "node", "component", component)
    # two sums of 64-bit hashes stand for the members of a bucket
    marks = [F.sum(F.xxhash64(F.lit(salt), "node").cast("decimal(20,0)")).alias(salt) for salt in ("m1", "m2")]
    sizes = member.groupBy("bucket", "component").agg(F.count("*").alias("n"), *marks)
    top = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts"),
                                      F.sum("n").alias("n"), F.sum("m1").alias("m1"), F.sum("m2").alias("m2")).where("parts > 1")
    # buckets with the same members are looked at once
    one = F.min(F.struct("bucket", "top.component", (F.col("n") - F.col("top.n")).alias("n_minor")))
    top = stage_table(top.groupBy("n", "m1", "m2").agg(one.alias("one"))
                      .select("one.bucket", F.col("one.component").alias("main"), "n", "one.n_minor"),
                      "minhash-open", files(n_members, MEMBER_ROWS))
    open_members = stage_table(member.join(top, "bucket").select(
        "bucket", "band", "node", "component", (F.col("component") != F.col("main")).alias("minor"), "n", "n_minor"),
        "minhash-open-members", files(n_members, MEMBER_ROWS))
    lists = open_members.groupBy("node").agg(F.collect_list(F.struct("band", "bucket")).alias("all"))
    long = stage_table(long_signatures(sets.join(lists, "node").coalesce(files(n_active, LONG_ROWS))), "minhash-long")
    pairs = stage_table(_block_pairs(open_members.join(long, "node")), "minhash-pairs")
    n_pairs = pairs.count()
    more = stage_table(_confirm(pairs, sets, percent).unionByName(links), "minhash-links", files(n_pairs + n_active, SET_ROWS))
    drop_staged(links, component, top, open_members, long, pairs, sets, members, buckets, pivots)
    component = labels_of_others(more, n_active + n_stars + n_pairs)
    return labelled(classes, "node", "component", component).select("key1", "key2", "rep", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: (id_col, n_shingles, component_id, kept).

    Words are maximal runs without ASCII white space, A-Z lower-cased; a text
    has the set of its distinct ``k``-word shingles, or its whole word
    sequence if it is shorter.  Documents are linked when 100 * shared >=
    percent * union; component_id is the smallest id reachable over links and
    kept marks the document that has it.

    Null, empty and blank texts have an empty set and are linked with nothing.
    A null id gives a row with its set size, a null component and kept false;
    its text links nothing.  Rows that repeat an id count as one document per
    distinct text but share the id: what is linked with one of the texts is
    not thereby linked with the other; exact repeats of a row are all returned.
    An empty table gives an empty result.  Other columns are ignored.
    """
    texts = named_texts(docs, id_col, text_col)
    staged = stage_table(signatures(texts, k), "minhash")
    classes = _classes(staged.where("id IS NOT NULL AND n_shingles > 0"), texts, k, percent)
    least = classes.groupBy("component").agg(F.min("rep.id").alias("component_id"))
    of_class = classes.join(least, "component").select("key1", "key2", "component_id")
    return staged.select("id", "n_shingles", "key1", "key2").join(of_class, ["key1", "key2"], "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")))
        .alias("component_id")).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one of each
    group of near-duplicates stays: the one with the smallest id (rows without
    an id last), then by hashes of the text.

    Rows that repeat an id and its text, or a text without an id, count once;
    of them the row that is smallest, column by column, stays.  Documents
    without words are near-duplicates of nothing and all stay.  Links are
    those of ``near_duplicates``, for rows without an id too.  Texts are not
    shuffled with the keys: the rows that go are found first, and the table is
    read once more without them.  Any further column passes through whatever
    its name; an empty table stays empty.
    """
    texts = named_texts(docs, id_col, text_col)
    staged = stage_table(signatures(texts, k), "minhash")
    words = staged.where("n_shingles > 0")
    classes = _classes(words, texts, k, percent)
    best = classes.groupBy("component").agg(F.min("rep").alias("best"))
    best = stage_table(best.select("best.id", "best.t1", "best.t2"), "minhash-kept")
    names = words.groupBy("id", "t1", "t2").agg(F.count("*").alias("n"))
    match = lambda a, b: [a["id"].eqNullSafe(b["id"]), a["t1"] == b["t1"], a["t2"] == b["t2"]]
    gone = names.join(best, match(names, best), "left_anti").select("id", "t1", "t2")
    again = stage_table(names.where("n > 1").join(best, match(names, best), "left_semi").select("id", "t1", "t2"), "minhash-again")
    text = docs[text_col]
    row = lambda other: [docs[id_col].cast("long").eqNullSafe(other["id"]), F.xxhash64(text) == other["t1"],
                         F.xxhash64(F.lit("text"), text) == other["t2"]]
    if again.isEmpty():
        return docs.join(gone, row(gone), "left_anti")
    leave = stage_table(gone.unionByName(again), "minhash-gone")
    repeated = docs.join(again, row(again), "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = (repeated.groupBy(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t")).agg(F.min(whole).alias("one"))
            .select("one.*"))
    return docs.join(leave, row(leave), "left_anti").unionByName(once)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of ``documents`` over 4-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", k=4)
