import base64
import gzip
import hashlib
import io
from collections import defaultdict
from pathlib import Path

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from popscope.llm.common import table
from popscope.llm.warc import open_manifest, read_archives, records, write_archives

SCHEMA = "page_id long, url string, html string"
ODD = [
    (5, "http://a/", "same"), (3, "http://b/", "same"), (9, None, "same"), (9, None, "same"), (1, "http://x/\r\nX: y", None), (2, "http://é/", ""),
    (None, "http://n/", "alone"), (None, "http://n/", "alone"), (None, "http://n/", "same"), (4, "u", "WARC/1.1\r\n\r\n é 🙂 \x00"), (6, "u", "x" * 300_000), (7, "u", "x" * 300_000),
]


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def written(pages, folder, **options):
    write_archives(pages, str(folder), **options)
    return read_archives(pages.sparkSession, str(folder)).collect()


def test_odd_pages(spark, tmp_path):
    pages = spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "payload", "shard", "kind", "first", "sha1")}).repartition(4)
    rows = written(pages, tmp_path / "a", shard_bytes=100_000, file_bytes=200)
    assert len(rows) == len(ODD)
    by_page = defaultdict(list)
    for r in rows:
        by_page[r.page_id].append(r)
    for page, _, html in ODD:
        assert any(r.payload_digest == sha1(html) and r.payload_bytes == len((html or "").encode()) for r in by_page[None if page is None else str(page)])
    kinds = {p: sorted((r.record_type, r.refers_to) for r in rs) for p, rs in by_page.items() if p}
    assert kinds == {
        "1": [("response", None)], "2": [("revisit", "1")], "3": [("response", None)], "4": [("response", None)], "5": [("revisit", "3")],
        "6": [("response", None)], "7": [("revisit", "6")], "9": [("revisit", "3")] * 2,
    }
    nulls = sorted((r.payload_digest == sha1("same"), r.record_type, str(r.refers_to)) for r in by_page[None])
    assert nulls[-1] == (True, "revisit", "3") and len(nulls) == 3
    assert [r.payload.decode() for r in by_page["4"]] == [ODD[9][2]] and by_page["1"][0].url == "http://x/%0D%0AX: y"


def test_repeated_smallest_page(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a"), (1, "u", "a"), (1, "u", "b"), (2, "u", "a")], SCHEMA)
    rows = written(pages, tmp_path / "a")
    assert sorted((r.page_id, r.record_type, r.refers_to or "", r.payload_digest == sha1("a")) for r in rows) == [
        ("1", "response", "", False), ("1", "response", "", True), ("1", "revisit", "1", True), ("2", "revisit", "1", True)]


def test_files_are_the_same_however_pages_are_dealt(spark, tmp_path):
    pages = table(spark, TESTDATA, "pages")
    seen = []
    for i, parts in enumerate((1, 6)):
        write_archives(pages.repartition(parts), str(tmp_path / str(i)), shard_bytes=30_000, file_bytes=5_000)
        files = sorted(Path(tmp_path / str(i)).glob("*.warc.gz"))
        seen.append([(f.name, hashlib.sha1(f.read_bytes()).hexdigest()) for f in files])
        manifest = open_manifest(spark, str(tmp_path / str(i))).collect()
        assert sorted((m.name, m.sha1) for m in manifest) == seen[-1]
        assert sum(m.records for m in manifest) == pages.count()
        assert not list((tmp_path / str(i) / "_temporary").iterdir())
    assert seen[0] == seen[1] and len(seen[0]) > 8
    ids = [int(h["x-page-id"]) for f in sorted((tmp_path / "0").glob("*.warc.gz")) for h, _ in records(gzip.open(f)) if "x-page-id" in h]
    assert ids == sorted(ids)


def test_least_and_empty(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", ""), (4, "u", None)], SCHEMA)
    rows = written(pages, tmp_path / "a", least=1)
    assert sorted((r.page_id, r.record_type) for r in rows) == [("1", "response"), ("2", "revisit"), ("3", "response"), ("4", "response")]
    assert written(pages.limit(0), tmp_path / "b") == []


def test_a_changed_file_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abcdef")], SCHEMA)
    write_archives(pages, str(tmp_path / "a"))
    file = next((tmp_path / "a").glob("*.warc.gz"))
    file.write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).replace(b"abcdef", b"abcdeg")))
    (tmp_path / "a" / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="does not match its digest"):
        read_archives(spark, str(tmp_path / "a")).collect()


def test_records_end_where_they_should():
    with pytest.raises(ValueError):
        list(records(io.BytesIO(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcd")))
