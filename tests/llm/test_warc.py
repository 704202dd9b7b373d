import gzip
import hashlib
import os
import shutil

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


def brute(rows):
    """(page_id, bytes, digest, type, refers_to) by the definition."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] is None, rows[i][1] or ""))
    first, out = {}, []
    for i in order:
        page, _, html = rows[i]
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        again = len(data) >= 100 and digest in first
        out.append((page, len(data), digest, "revisit" if again else "response", first[digest] if again else None))
        if len(data) >= 100:
            first.setdefault(digest, page)
    return out


def key(r):
    return tuple((x is None, str(x)) for x in r)


def back(spark, target, **options):
    from aerotrace.llm.warc import read_archive
    return read_archive(spark, target, **options).collect()


def plain(records):
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records], key=key)


def files(target):
    return {f: open(os.path.join(target, f), "rb").read() for f in sorted(os.listdir(target)) if f.endswith(".gz")}


LONG = "<p>" + "the same page " * 20
ODD = [(5, "http://a/b c\r\nX: y é", LONG), (3, None, LONG), (9, "", LONG), (9, "", LONG), (None, "http://n", LONG), (None, None, None),
       (1, "http://e", ""), (2, "http://e", None), (4, "u", "x" * 99), (6, "u", "x" * 99), (7, "u", "y" * 100), (8, "v", "y" * 100),
       (10, "w", "é" * 50), (11, "w", "é" * 50), (12, "z", "\0\r\n\r\nWARC/1.1" * 30), (13, "long", "long text " * 300000),
       (None, "http://n2", "n" * 500), (None, "http://n3", "n" * 500), (-4, "m", LONG)]


def test_documents_equal_brute_force(spark):
    from aerotrace.llm.warc import op12_warc_archive
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert plain(op12_warc_archive(spark, SF).collect()) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("sizes", [{}, {"file_bytes": 1}, {"shard_bytes": 600, "file_bytes": 800}])
def test_odd_rows(spark, tmp_path, sizes):
    from aerotrace.llm.warc import write_archive
    target = str(tmp_path / "w")
    pages = spark.createDataFrame([(*r, 1, "x") for r in ODD], SCHEMA + ", shard int, digest string").repartition(5)
    manifest = write_archive(pages, target, **sizes).collect()
    records = back(spark, target, payloads=True)
    assert plain(records) == sorted(brute(ODD), key=key)
    want = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in ODD}
    assert all(bytes(r.payload) == want[r.payload_digest] if r.record_type == "response" else r.payload is None for r in records)
    assert sorted(files(target)) == sorted(r.file for r in manifest) and not os.path.exists(f"{target}/_temporary")
    assert sum(r.n_records for r in manifest) == len(ODD) and all(r.n_bytes == len(files(target)[r.file]) for r in manifest)
    if sizes.get("file_bytes") == 1:
        assert len(manifest) == len(ODD)


def test_files_are_plain_warc_in_page_order_and_the_same_again(spark, tmp_path):
    from aerotrace.llm.warc import write_archive
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for name, parts in (("a", 2), ("b", 7)):
        write_archive(pages.repartition(parts), str(tmp_path / name), shard_bytes=30000, file_bytes=6000)
    a, b = files(tmp_path / "a"), files(tmp_path / "b")
    assert a == b and len(a) > 5
    ids = []
    for data in a.values():
        text = gzip.decompress(data)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        ids += [int(x.split(b"\r\n")[0]) for x in text.split(b"\r\nX-Page-ID: ")[1:]]
    assert ids == sorted(ids) and len(ids) == pages.count()


def test_damage_and_missing_manifest_raise(spark, tmp_path):
    from aerotrace.llm.warc import write_archive
    target = str(tmp_path / "w")
    write_archive(spark.createDataFrame(ODD, SCHEMA), target)
    name, data = next(iter(files(target).items()))
    with open(f"{target}/{name}", "wb") as f:
        f.write(data[:-30])
    with pytest.raises(Exception, match="cut off|not the file|Error"):
        back(spark, target)
    shutil.move(f"{target}/_manifest", f"{target}/away")
    with pytest.raises(Exception):
        back(spark, target)


def test_a_task_that_runs_again_leaves_one_set_of_files(spark, tmp_path):
    """The rows of an attempt that was not committed are not in the manifest."""
    from aerotrace.llm.warc import _File, write_archive
    target = str(tmp_path / "w")
    lost = _File(target, 0, 0, 999999)
    lost.page(77, b"half a record", False)
    lost.close()
    write_archive(spark.createDataFrame(ODD, SCHEMA), target)
    assert plain(back(spark, target)) == sorted(brute(ODD), key=key)


def test_empty_table(spark, tmp_path):
    from aerotrace.llm.warc import write_archive
    assert write_archive(spark.createDataFrame([], SCHEMA), str(tmp_path / "w")).count() == 0
    assert back(spark, str(tmp_path / "w")) == []
