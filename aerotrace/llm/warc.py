"""Deterministic sharded WARC archives.

Pages are range-sorted by page id into shards whose bounds follow from exact
prefix sums of the payload sizes, so the same pages give the same files
whatever the cluster.  A task streams the sorted rows of a shard into gzip
members, one per record, with headers and digests made anew, and starts the
next file when the compressed size is reached.

Files are written under temporary names with the task attempt in them.  Only
the rows that a committed attempt returned are in the manifest; a second job
moves exactly those files to their final names (a move that is already done
is skipped) and writes the manifest, without which the archive does not
exist.  A task that runs twice therefore leaves nothing behind.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerotrace.llm.prefix import running_sums
from aerotrace.session import drop_staged, shared_path, stage_table

#: Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 100
#: A shard holds the total divided by this, within these bytes.
SHARDS, LEAST_SHARD, MOST_SHARD = 1024, 4 << 20, 1 << 30
#: Compressed bytes after which a shard goes on in its next file.
FILE_BYTES = 256 << 20
HEADERS = 1 << 9  # bytes a record takes beside its payload, about
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST_SCHEMA = ("shard int, seq int, temporary string, file string, n_records long, n_revisits long, n_bytes long, "
                   "sha256 string, first_page long, last_page long")
RECORD_SCHEMA = ("page_id long, target_uri string, record_type string, payload_bytes long, payload_digest string, "
                 "refers_to long, file string, place long, payload binary")


def file_system(path: str):
    """(pyarrow file system, path in it) of a qualified path."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark would use."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(p).toString()


# -- records ------------------------------------------------------------------

def record_id(page_id, url, digest: str, repeat: int) -> str:
    name = repr((page_id, url, digest, repeat)).encode()
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name).digest()[:16], version=4)}>"


def target_uri(page_id, url) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else f"urn:page:{'' if page_id is None else page_id}"


def record(page_id, url, payload: bytes, digest: str, repeat: int, original=None) -> bytes:
    """One WARC record; ``original`` is (page id, url) of the response that a
    revisit refers to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if original else http + payload
    uri = target_uri(page_id, url)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if original else 'response'}",
             f"WARC-Record-ID: {record_id(page_id, url, digest, repeat)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if original:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(*original, digest, 0)}",
                  f"WARC-Refers-To-Target-URI: {target_uri(*original)}", f"WARC-Refers-To-Date: {DATE}"]
        if original[0] is not None:
            lines.append(f"X-Refers-To-Page-ID: {original[0]}")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info(name: str) -> bytes:
    block = b"software: aerotrace\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id(None, name, '', 0)}", f"WARC-Date: {DATE}",
            f"WARC-Filename: {name}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
            "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(data) + gz.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record; raises where length or digest differ."""
    end = data.index(b"\r\n\r\n")
    version, *lines = data[:end].decode().split("\r\n")
    head = dict(line.split(": ", 1) for line in lines)
    block = data[end + 4:-4]
    if not version.startswith("WARC/") or data[-4:] != b"\r\n\r\n" or len(block) != int(head["Content-Length"]):
        raise ValueError(f"broken record {head.get('WARC-Record-ID')}")
    if f"sha256:{hashlib.sha256(block).hexdigest()}" != head["WARC-Block-Digest"]:
        raise ValueError(f"digest of record {head['WARC-Record-ID']} differs")
    return head, block


# -- writing ------------------------------------------------------------------

class _File:
    """A file being written, under its temporary name."""

    def __init__(self, target: str, shard: int, seq: int, attempt: int):
        self.shard, self.seq = shard, seq
        self.name = f"pages-{shard:06d}-{seq:04d}.warc.gz"
        self.temporary = f"_temporary/{self.name}.{attempt}"
        fs, root = file_system(target)
        fs.create_dir(f"{root}/_temporary", recursive=True)
        self.out, self.sha, self.n_bytes = fs.open_output_stream(f"{root}/{self.temporary}"), hashlib.sha256(), 0
        self.records = self.revisits = 0
        self.first = self.last = None
        self.add(info(self.name))

    def add(self, data: bytes) -> None:
        data = member(data)
        self.out.write(data)
        self.sha.update(data)
        self.n_bytes += len(data)

    def page(self, page_id, data: bytes, revisit: bool) -> None:
        self.add(data)
        self.records += 1
        self.revisits += revisit
        self.first, self.last = (page_id if self.records == 1 else self.first), page_id

    def close(self) -> tuple:
        self.out.close()
        return (self.shard, self.seq, self.temporary, self.name, self.records, self.revisits, self.n_bytes,
                self.sha.hexdigest(), self.first, self.last)


def _writer(target: str, file_bytes: int):
    def run(batches):
        from pyspark import TaskContext
        attempt, file, before, repeat = TaskContext.get().taskAttemptId(), None, None, 0
        names = [f.split(" ")[0] for f in MANIFEST_SCHEMA.split(", ")]

        def closed():
            row = file.close()
            schema = pa.schema([(n, pa.int32() if n in ("shard", "seq") else pa.string() if n in ("temporary", "file", "sha256")
                                 else pa.int64()) for n in names])
            return pa.RecordBatch.from_pylist([dict(zip(names, row))], schema=schema)

        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                if file is not None and (row["shard"] != file.shard or file.n_bytes >= file_bytes):
                    seq = file.seq + 1 if row["shard"] == file.shard else 0
                    yield closed()
                    file = _File(target, row["shard"], seq, attempt)
                file = file or _File(target, row["shard"], 0, attempt)
                same = (row["page_id"], row["url"], row["digest"])
                repeat, before = (repeat + 1 if same == before else 0), same
                original = None
                if row["copied"] and (repeat or (row["first_page"], row["first_url"]) != same[:2]):
                    original = (row["first_page"], row["first_url"])
                file.page(row["page_id"], record(row["page_id"], row["url"], bytes(row["payload"]), row["digest"], repeat, original),
                          original is not None)
        if file is not None:
            yield closed()

    return run


def shard_bounds(rows: DataFrame, shard_bytes: int | None = None) -> tuple[np.ndarray, DataFrame, int]:
    """(first page id of each shard, heavy ids, number of shards) for
    ``rows(page_id, bytes)``.

    Both depend on the rows alone.  There are at most total / shard size
    bounds (one number each) and heavy ids: an id (or no id) with more bytes
    than a shard gets shards of its own, numbered from ``base`` on, ``parts``
    of them (at most one a row), and its rows are dealt over them by digest."""
    per_id = stage_table(rows.groupBy("page_id").agg(F.sum(F.col("bytes") + HEADERS).alias("bytes"),
                                                    F.count("*").alias("n")), "warc-sizes")
    total = per_id.agg(F.sum("bytes")).first()[0] or 0
    size = shard_bytes or min(max(total // SHARDS, LEAST_SHARD), MOST_SHARD)
    heavy = per_id.where((F.col("bytes") > size) | F.col("page_id").isNull()).select(
        F.col("page_id").alias("heavy_id"), F.least("n", F.ceil(F.col("bytes") / size)).cast("int").alias("parts"))
    light = per_id.where((F.col("bytes") <= size) & F.col("page_id").isNotNull())
    placed = running_sums(light, [F.col("page_id")], {"before": "bytes"})
    firsts = placed.groupBy(F.floor(F.col("before") / size).alias("shard")).agg(F.min("page_id").alias("first")).collect()
    bounds = np.array(sorted(r["first"] for r in firsts), dtype=np.int64)
    placed = running_sums(heavy, [F.col("heavy_id").asc_nulls_last()], {"before": "parts"})
    heavy = stage_table(placed.select("heavy_id", "parts", (F.col("before") + len(bounds)).cast("int").alias("base")), "warc-heavy")
    return bounds, heavy, len(bounds) + (heavy.agg(F.sum("parts")).first()[0] or 0)


def write_archive(pages: DataFrame, target: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  file_bytes: int = FILE_BYTES, shard_bytes: int | None = None) -> DataFrame:
    """Write one record per row of ``pages`` to ``target`` and return the
    manifest (one row per file).

    Of rows with equal payloads of at least 100 bytes the one with the
    smallest (id, url), nulls last, is a response and the others revisit it,
    exact repeats of the row too; smaller payloads are responses all.  Null
    payloads are empty; null ids come last, in shards of their own; a null or
    empty url is replaced by a name made from the id; an empty table gives a
    manifest without files.  Other columns are ignored.
    """
    spark = pages.sparkSession
    target = qualified(spark, target)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    copies = (rows.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest")
              .agg(F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url"))
                   .alias("first"), F.count("*").alias("n")).where("n > 1"))
    copies = stage_table(copies.select(F.col("digest").alias("copy"), F.col("first.page_id").alias("first_page"),
                                       F.col("first.url").alias("first_url")), "warc-copies")
    bounds, heavy, n_shards = shard_bounds(rows.select("page_id", "bytes"), shard_bytes)
    shared = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(shared.value, ids.fillna(0).to_numpy(np.int64), side="right") - 1, 0))

    # short payloads, which are never looked up, spread by id instead of meeting under one digest
    key = F.when(F.col("bytes") >= LEAST_REVISIT, F.col("digest")).otherwise(
        F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), "url", F.lit(""))))
    placed = rows.withColumn("key", key).join(copies, F.col("key") == F.col("copy"), "left")
    placed = placed.join(F.broadcast(heavy), F.col("page_id").eqNullSafe(F.col("heavy_id")), "left")
    own = F.col("base") + F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int")
    placed = placed.select("page_id", "url", "payload", "digest", F.col("copy").isNotNull().alias("copied"), "first_page", "first_url",
                           F.coalesce(own, shard_of("page_id")).alias("shard"))
    order = [F.col("shard"), F.col("page_id").asc_nulls_last(), F.col("url").asc_nulls_last(), F.col("digest")]
    sorted_rows = placed.repartitionById(max(1, n_shards), F.col("shard")).sortWithinPartitions(*order)
    written = stage_table(sorted_rows.mapInArrow(_writer(target, file_bytes), MANIFEST_SCHEMA), "warc-files")

    def move(batches):
        for batch in batches:
            fs, root = file_system(target)
            for row in batch.to_pylist():
                final = f"{root}/{row['file']}"
                try:
                    fs.move(f"{root}/{row['temporary']}", final)
                except FileNotFoundError:  # another attempt of this task has moved it
                    pass
                if fs.get_file_info(final).size != row["n_bytes"]:
                    raise OSError(f"{final} is not the file of the manifest")
            yield batch

    written.mapInArrow(move, MANIFEST_SCHEMA).drop("temporary").write.mode("overwrite").parquet(f"{target}/_manifest")
    drop_staged(written, copies, heavy)
    rest = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_temporary")
    rest.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(rest, True)
    return spark.read.parquet(f"{target}/_manifest")


# -- reading ------------------------------------------------------------------

def members(stream, chunk: int = 1 << 20):
    """(place, bytes) of each gzip member of a stream; one at a time in memory."""
    gz, parts, place, at = zlib.decompressobj(31), [], 0, 0
    data = stream.read(chunk)
    while data:
        parts.append(gz.decompress(data))
        at += len(data) - len(gz.unused_data)
        if gz.eof:
            yield place, b"".join(parts)
            data, place = gz.unused_data, at
            gz, parts = zlib.decompressobj(31), []
            if data:
                continue
        data = stream.read(chunk)
    if parts:
        raise ValueError("the last record is cut off")


class _Hashed:
    """A stream that hashes what is read from it."""

    def __init__(self, stream):
        self.stream, self.sha = stream, hashlib.sha256()

    def read(self, n):
        data = self.stream.read(n)
        self.sha.update(data)
        return data


def read_archive(spark: SparkSession, target: str, payloads: bool = False) -> DataFrame:
    """The records of the files in the manifest, one row each: page_id,
    target_uri, record_type, payload_bytes and payload_digest (of the full
    payload, for revisits too), refers_to, file and place of the record, and
    the payload if asked for (null for revisits).

    Raises where a file, a block or a payload does not have its digest."""
    target = qualified(spark, target)
    manifest = spark.read.parquet(f"{target}/_manifest").select("file", "n_records", "sha256")
    columns = [f.split(" ") for f in RECORD_SCHEMA.split(", ")]
    schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in columns])

    def rows_of(row):
        fs, root = file_system(target)
        n = 0
        with fs.open_input_stream(f"{root}/{row['file']}", compression=None) as raw:
            stream = _Hashed(raw)
            for place, data in members(stream):
                head, block = parse(data)
                if head["WARC-Type"] == "warcinfo":
                    continue
                n += 1
                cut = block.index(b"\r\n\r\n") + 4
                size = int(block[:cut].decode().split("Content-Length: ")[1].split("\r\n")[0])
                digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                response = head["WARC-Type"] == "response"
                if response and (len(block) - cut != size or hashlib.sha256(memoryview(block)[cut:]).hexdigest() != digest):
                    raise ValueError(f"payload of {head['WARC-Record-ID']} differs")
                page, refers = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
                yield (None if page is None else int(page), head["WARC-Target-URI"], head["WARC-Type"], size, digest,
                       None if refers is None else int(refers), row["file"], place, block[cut:] if payloads and response else None)
        if n != row["n_records"] or stream.sha.hexdigest() != row["sha256"]:
            raise ValueError(f"{row['file']} is not the file of the manifest")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for r in rows_of(row):
                    held.append(dict(zip(schema.names, r)))
                    size += 1024 + len(r[-1] or b"")
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    return manifest.repartition(max(1, manifest.count())).mapInArrow(run, RECORD_SCHEMA)


def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC files and read back."""
    target = shared_path(spark, f"warc-{uuid.uuid4().hex}")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), target)
    return read_archive(spark, target).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP12_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id <> first THEN first END AS refers_to
FROM f
"""
