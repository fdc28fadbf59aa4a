"""A deterministic sharded WARC writer, and a reader.

Records are cut into shards by ranges of their id and sorted; a shard's file is closed once
its compressed size reaches a bound and the next one begun. Headers and digests are made
anew from the payload. Of records with equal payloads that with the smallest id is a
response, the others are revisits of it. The range bounds come from the ids with the
smallest hashes, so equal tables give equal files, byte for byte, however they are partitioned.

Commit: every attempt of a task writes under temporary names. The names that finished
attempts report are stored by Spark as a manifest; the files named there are renamed, which
may be repeated, and last the manifest itself is. Readers go by the manifest alone, so lost
executors and repeated tasks leave at most unread temporary files.

Null payloads are empty. Null ids come first and sort as one id; a group of equal payloads
without any id has null as the id it refers to. Repeated rows: the first is the response,
the others revisit it. Null urls have no target header; line breaks in urls are escaped.
An empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popscope.llm.common import stored

DATE = "1970-01-01T00:00:00Z"  # no clock enters the files
SHARD_BYTES = 32 << 20  # payload bytes per shard, about
MOST_SHARDS = 8192
SAMPLED_IDS = 1 << 16  # ids that the range bounds are taken from
FILE_BYTES = 16 << 20  # compressed size at which a file is closed
LEVEL = 3
IDS = uuid.UUID("5a1f7c1e-6f6b-5d0c-9d55-6a3c2f0e9b11")  # namespace of the record ids
MANIFEST = "shard int, seq int, name string, temporary string, bytes long, records long, sha1 string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: str | None, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(IDS, f'{page}/{sha1}')}>"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return b"WARC/1.1\r\n" + lines.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def page_record(page: str | None, url: str | None, payload: bytes, refers_to: tuple[str | None] | None) -> bytes:
    """A response, or a revisit of the record of page ``refers_to[0]``."""
    sha1 = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    headers = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", record_id(page, sha1)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    headers += [("WARC-Payload-Digest", f"sha1:{sha1}"), ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if page is not None:
        headers.append(("X-Page-ID", page))
    if refers_to:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("WARC-Refers-To", record_id(refers_to[0], sha1)))
        if refers_to[0] is not None:
            headers.append(("X-Refers-To-Page-ID", refers_to[0]))
    return _record([*headers, ("Content-Type", "application/http;msgtype=response")], block)


def member(record: bytes) -> bytes:
    """The record as a gzip member of its own, without a time."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


class _Files:
    """The files of one shard, one after the other."""

    def __init__(self, folder: str, shard: int, bound: int):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.shard, self.bound, self.seq, self.out = shard, bound, -1, None

    def add(self, record: bytes) -> dict | None:
        """Writes; gives the manifest row of a file that this record closed."""
        if self.out is None:
            self.seq += 1
            self.name = f"part-{self.shard:05d}-{self.seq:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
            self.bytes, self.records, self.sha1 = 0, 0, hashlib.sha1()
            info = _record(
                [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(self.name, "")), ("WARC-Date", DATE),
                 ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")],
                b"format: WARC File Format 1.1\r\n",
            )
            self._write(info)
        self._write(record)
        self.records += 1
        return self.close() if self.bytes >= self.bound else None

    def _write(self, record):
        packed = member(record)
        self.out.write(packed)
        self.bytes += len(packed)
        self.sha1.update(packed)

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        return {"shard": self.shard, "seq": self.seq, "name": self.name, "temporary": self.temporary,
                "bytes": self.bytes, "records": self.records, "sha1": self.sha1.hexdigest()}


def write_archives(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", payload: str = "html",
    least: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes the archives below ``folder`` and returns their manifest.

    ``least``: payloads of fewer bytes are always responses.
    """
    spark = pages.sparkSession
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{root}/_temporary", recursive=True)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id).alias("id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    marks = stored(
        rows.select("id", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("bytes")), "marks"
    )
    shard = _sharder(marks, max(1, shard_bytes))
    shards = shard.shards

    # Counting before joining: the join sees narrow rows, and only payloads that repeat.
    same = marks.where(F.col("bytes") >= least).groupBy("sha1").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    same = same.where("n > 1").select("sha1", "first")
    revisits = marks.join(same, "sha1").select("id", "sha1", "first").distinct()

    none = lambda kind: F.lit(None).cast(kind)
    records = rows.select("id", F.sha1("payload").alias("sha1"), F.lit(1).alias("kind"), "url", "payload", none("string").alias("first"))
    notes = revisits.select(
        "id", "sha1", F.lit(0).alias("kind"), none("string").alias("url"), none("binary").alias("payload"),
        F.struct((F.col("id").eqNullSafe(F.col("first"))).alias("own"), F.col("first").cast("string").alias("first")).alias("note"),
    )
    notes = notes.select("id", "sha1", "kind", "url", "payload", F.concat(F.when(F.col("note.own"), "=").otherwise(">"), F.coalesce("note.first", F.lit(""))).alias("first"))
    both = records.unionByName(notes).withColumn("shard", shard(F.col("id")))
    dealt = both.repartitionById(shards, "shard").sortWithinPartitions("shard", "id", "sha1", "kind")
    ordered = dealt.select("shard", F.col("id").cast("string").alias("id"), "sha1", "kind", "url", "payload", "first")
    staged = ordered.mapInArrow(_writer(folder, file_bytes), MANIFEST)
    staged.write.parquet(f"{folder}/_manifest")

    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    manifest.repartition("name").mapInArrow(_renamer(folder), "done long").agg(F.sum("done")).collect()
    store.move(f"{root}/_manifest", f"{root}/manifest")
    return open_manifest(spark, folder)


def _sharder(marks: DataFrame, shard_bytes: int):
    """A function from ids to shards, by ranges of about equal numbers of rows."""
    total = marks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    wanted = min(MOST_SHARDS, max(1, math.ceil(total / shard_bytes)))
    ids = marks.where("id IS NOT NULL").select("id", F.xxhash64("id").alias("h"))
    sample = sorted(row["id"] for row in ids.orderBy("h", "id").limit(SAMPLED_IDS).collect())
    bounds = sorted({sample[len(sample) * i // wanted] for i in range(1, wanted)}) if sample else []
    kind = object if bounds and isinstance(bounds[0], str) else None
    array = np.array(bounds, dtype=kind)

    @F.pandas_udf("int")
    def shard(ids: pd.Series) -> pd.Series:
        found, there = np.zeros(len(ids), np.int32), ids.notna().to_numpy()
        if there.any() and len(array):
            found[there] = np.searchsorted(array, ids[there].to_numpy().astype(array.dtype), side="right")
        return pd.Series(found)

    shard.shards = len(bounds) + 1
    return shard


def _writer(folder: str, bound: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, note, done = None, None, []
        for batch in batches:
            for row in _rows(batch):
                if files is None or row["shard"] != files.shard:
                    done += [files and files.close()]
                    files = _Files(folder, row["shard"], bound)
                key = (row["id"], row["sha1"])
                if row["kind"] == 0:  # what the next records of this id and payload are
                    note = [key, row["first"][0] == "=", row["first"][1:] or None]
                    continue
                refers = None
                if note and note[0] == key:
                    refers, note[1] = None if note[1] else (note[2],), False
                done.append(files.add(page_record(row["id"], row["url"], row["payload"], refers)))
        done.append(files and files.close())
        yield pa.RecordBatch.from_pylist([d for d in done if d], schema=MANIFEST_SCHEMA)

    return write


def _rows(batch: pa.RecordBatch, step: int = 256) -> Iterator[dict]:
    for start in range(0, batch.num_rows, step):
        yield from batch.slice(start, step).to_pylist()


MANIFEST_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("seq", pa.int32()), ("name", pa.string()), ("temporary", pa.string()),
     ("bytes", pa.int64()), ("records", pa.int64()), ("sha1", pa.string())]
)


def _renamer(folder: str):
    def rename(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in _rows(batch):
                old, new = f"{root}/{row['temporary']}", f"{root}/{row['name']}"
                if store.get_file_info(new).type == fs.FileType.NotFound:
                    store.move(old, new)
            yield pa.RecordBatch.from_pydict({"done": [batch.num_rows]})

    return rename


def open_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a committed set of archives."""
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: page_id (as text), url, payload, payload_bytes, payload_digest, record_type, refers_to (as text).

    ``payload`` is null for revisits, whose digest and size are those of the full payload.
    A record that does not match its digest fails the job.
    """
    schema = "page_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string"
    files = open_manifest(spark, folder).select("name")
    count = max(1, files.count())
    return files.repartition(min(count, 10_000), "name").mapInArrow(_reader(folder), schema)


READ_SCHEMA = pa.schema(
    [("page_id", pa.string()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())]
)


def _reader(folder: str):
    def read(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in _rows(batch):
                held, size = [], 0
                with store.open_input_stream(f"{root}/{row['name']}", compression=None) as raw:
                    for headers, block in records(gzip.GzipFile(fileobj=raw)):
                        if headers["warc-type"] == "warcinfo":
                            continue
                        held.append(_page_row(headers, block))
                        size += len(block)
                        if size > 4 << 20 or len(held) >= 5000:
                            yield pa.RecordBatch.from_pylist(held, schema=READ_SCHEMA)
                            held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=READ_SCHEMA)

    return read


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record."""
    stream = io.BufferedReader(stream, 1 << 18)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name.lower()] = value
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} does not end where it should")
        yield headers, block


def _page_row(headers: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(h.split(b":")[1]) for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:"))
    stated = headers["warc-payload-digest"].removeprefix("sha1:")
    response = headers["warc-type"] == "response"
    if f"sha1:{digest(block)}" != headers["warc-block-digest"] or response and (digest(payload) != stated or len(payload) != size):
        raise ValueError(f"record {headers['warc-record-id']} does not match its digest")
    return {
        "page_id": headers.get("x-page-id"), "url": headers.get("warc-target-uri"), "payload": payload if response else None,
        "payload_bytes": size, "payload_digest": stated, "record_type": headers["warc-type"],
        "refers_to": headers.get("x-refers-to-page-id"),
    }
