"""WARC archives through a chunked record table.

A payload travels as rows (rec, chunk, data) of at most `chunk_bytes`, the
record's identifier and the chunk's number; digests are carried from chunk to
chunk. Writer and reader touch one chunk at a time, so a record of any size
needs the memory of a chunk.

Writing: each task gets whole records (rows hash-partitioned by record, sorted
by record and chunk, a record's head before its chunks) and writes files of
gzip members, one record each, into the shared folder by pyarrow's file
systems. A file is written under the attempt's own name and renamed at its end;
its content depends on its rows only, so a task that runs again after a lost
executor or beside a slow twin puts the same file in place. Archives are
known by the manifest that the tasks return, never by listing the folder.

Of records with equal payloads of at least `revisit_bytes`, the one with the
largest id is written in full; the others are revisit records without payload.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickguard.llm.common import stored
from clickguard.session import scratch_path

CHUNK_BYTES = 64 << 10
REVISIT_BYTES = 1000
FILE_BYTES = 1 << 30
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LEVEL = 1
_ROWS = 1024

_RECORD = ("file string, record_id string, warc_type string, id string, target_uri string, "
           "refers_to string, stated_bytes long, stated_digest string")
_CHUNK = _RECORD + ", chunk long, bytes long, payload_bytes long, payload_digest string, last boolean"


def _folder(uri: str):
    """The file system and path of a folder of the cluster."""
    uri = re.sub("^s3[an]:", "s3:", uri)
    return pafs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri))


def chunk_table(records: DataFrame, id_col: str, uri_col: str, payload_col: str,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(rec, id, uri, chunk, data): the payloads as rows of at most
    `chunk_bytes`; an empty or null payload is one empty chunk. rec is a hash of
    id, uri and payload, so rows share it only if they are repeats."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = records.select(F.col(id_col).alias("id"), F.col(uri_col).cast("string").alias("uri"),
                          payload.alias("payload"))
    rows = rows.select(F.sha1(F.concat_ws("\0", part("id"), part("uri"), F.md5("payload"))).alias("rec"),
                       "id", "uri", "payload")
    last = F.greatest(F.ceil(F.octet_length("payload") / chunk_bytes) - 1, F.lit(0)).cast("int")
    return (rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
            .select("rec", "id", "uri", "chunk",
                    F.substring("payload", F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes))
                    .alias("data")))


def record_digests(chunks: DataFrame) -> DataFrame:
    """(rec, id, uri, payload_bytes, payload_digest) of a chunk table whose
    records stand in order, chunk after chunk: SHA-1 in lower-case hex."""
    kind = chunks.schema["id"].dataType.simpleString()

    def run(batches):
        name, size, sha = None, 0, None
        for b in batches:
            done = []

            def close(name=None):
                done.append((*name, size, sha.hexdigest()))

            ids = b.column("id")
            for i, (rec, uri, chunk, data) in enumerate(zip(
                    b.column("rec").to_pylist(), b.column("uri").to_pylist(),
                    b.column("chunk").to_pylist(), b.column("data"))):
                if chunk == 0:
                    if name:
                        close(name)
                    name, size, sha = (rec, ids[i].as_py(), uri), 0, hashlib.sha1()
                data = data.as_buffer()
                size += data.size
                sha.update(data)
            if done:
                yield table(done)
        if name:
            yield table([(*name, size, sha.hexdigest())])

    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()

    def table(rows):
        kinds = [pa.string(), id_type, pa.string(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
            ["rec", "id", "uri", "payload_bytes", "payload_digest"])

    if kind not in ("bigint", "int", "string"):
        raise TypeError(f"ids of type {kind}")
    return chunks.select("rec", "id", "uri", "chunk", "data").mapInArrow(
        run, f"rec string, id {kind}, uri string, payload_bytes long, payload_digest string")


def heads(digests: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """One row per record identifier: what its header says, `copies` rows of
    the input, and in `refers` the record that a revisit refers to."""
    each = digests.groupBy("rec", "id", "uri", "payload_bytes", "payload_digest").agg(
        F.count("*").alias("copies"))
    best = (each.where(F.col("payload_bytes") >= revisit_bytes).groupBy("payload_digest")
            .agg(F.max(F.struct("id", "rec")).alias("first"), F.sum("copies").alias("rows"))
            .where("rows > 1")
            .select("payload_digest", F.col("first.rec").alias("first"), F.lit(True).alias("big")))
    big = each.where(F.col("payload_bytes") >= revisit_bytes).join(best, "payload_digest", "left")
    small = each.where(F.col("payload_bytes") < revisit_bytes)
    return (big.withColumn("refers", F.when(F.col("first") != F.col("rec"), F.col("first")))
            .withColumn("again", F.lit(True)).drop("first", "big")
            .unionByName(small.withColumn("refers", F.lit(None).cast("string"))
                         .withColumn("again", F.lit(False))))


def _uuid(rec: str) -> str:
    return f"<urn:uuid:{rec[:8]}-{rec[8:12]}-{rec[12:16]}-{rec[16:20]}-{rec[20:32]}>"


def _uri(text: str) -> str:
    """White space and controls would end the header line."""
    return re.sub(r"[\x00-\x20\x7f\x85\xa0  ]",
                  lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), text)


class _Writer:
    """Rolling files of one task."""

    def __init__(self, folder: str, file_bytes: int):
        self.fs, self.path = _folder(folder)
        self.limit, self.roll, self.out, self.rows = file_bytes, 0, None, []

    def open(self):
        task = TaskContext.get()
        self.name = f"{self.path}/part-{task.partitionId():06d}-{self.roll:04d}.warc.gz"
        self.own = f"{self.name}.{task.taskAttemptId()}"
        self.fs.create_dir(self.path, recursive=True)
        self.out, self.size, self.records, self.roll = self.fs.open_output_stream(
            self.own, compression=None), 0, 0, self.roll + 1
        self.begin([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _uuid(hashlib.sha1(
            self.name.rsplit("/", 1)[-1].encode()).hexdigest())), ("WARC-Date", DATE),
            ("Content-Type", "application/warc-fields"), ("Content-Length", "19")])
        self.put(b"software: chunked\r\n")
        self.end()

    def begin(self, fields):
        self.gz = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
        lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
        self.put(f"WARC/1.1\r\n{lines}\r\n".encode())

    def put(self, data):
        packed = self.gz.compress(data)
        self.out.write(packed)
        self.size += len(packed)

    def end(self):
        self.put(b"\r\n\r\n")
        tail = self.gz.flush()
        self.out.write(tail)
        self.size += len(tail)
        self.records += 1

    def record(self, h: dict, refers: str | None):
        """Opens a record; a response's payload follows."""
        if self.out is None or self.size >= self.limit:
            self.close()
            self.open()
        http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                f"Content-Length: {h['payload_bytes']}\r\n\r\n").encode()
        uri = _uri(h["uri"]) if h["uri"] else None
        self.begin([
            ("WARC-Type", "revisit" if refers else "response"),
            ("WARC-Record-ID", _uuid(h["name"])), ("WARC-Date", DATE), ("WARC-Target-URI", uri),
            ("WARC-Profile", PROFILE if refers else None),
            ("WARC-Refers-To", _uuid(refers) if refers else None),
            ("WARC-Payload-Digest", f"sha1:{h['payload_digest']}"),
            ("X-Page-ID", quote(str(h["id"]), safe="") if h["id"] is not None else None),
            ("Content-Type", "application/http;msgtype=response"),
            ("Content-Length", str(len(http) + (0 if refers else h["payload_bytes"])))])
        self.put(http)

    def close(self):
        if self.out is not None:
            self.out.close()
            self.fs.move(self.own, self.name)
            self.rows.append((self.name, self.records, self.size))
            self.out = None


def _write(folder: str, file_bytes: int):
    def copies(w: _Writer, h: dict, small: bytes):
        """The further rows of a repeated row."""
        for k in range(1, h["copies"]):
            h["name"] = hashlib.sha1(f"{h['rec']} {k}".encode()).hexdigest()
            w.record(h, (h["refers"] or h["rec"]) if h["again"] else None)
            if not h["again"]:
                w.put(small)
            w.end()

    def run(batches):
        w = _Writer(folder, file_bytes)
        h, small, seen = None, b"", -1

        def finish():
            if h:
                w.end()
                copies(w, h, small)

        for b in batches:
            for i, (rec, chunk) in enumerate(zip(b.column("rec").to_pylist(),
                                                 b.column("chunk").to_pylist())):
                if chunk < 0:
                    finish()
                    h = b.column("head")[i].as_py() | {"rec": rec, "name": rec}
                    small, seen = b"", -1
                    w.record(h, h["refers"])
                elif chunk > seen:  # a repeated row has its chunks twice
                    seen = chunk
                    data = b.column("data")[i].as_buffer()
                    if not h["refers"]:
                        w.put(data)
                    if not h["again"]:
                        small += data.to_pybytes()
        finish()
        w.close()
        if w.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*w.rows)],
                                             ["path", "records", "bytes"])
    return run


def write_warc(records: DataFrame, folder: str, id_col: str, uri_col: str, payload_col: str,
               chunk_bytes: int = CHUNK_BYTES, revisit_bytes: int = REVISIT_BYTES,
               file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes a record per row below `folder` (a URI that every executor
    reaches) and returns the manifest (path, records, bytes).

    A null payload is an empty one; a null or empty uri gives no target, a null
    id no id; repeated rows give a record each, of which one at most is a
    response if the payload reaches `revisit_bytes`; an empty table writes no
    file; other columns are not read.
    """
    chunks = chunk_table(records, id_col, uri_col, payload_col, chunk_bytes)
    digests = stored(record_digests(chunks), "warc-digests")
    top = heads(digests, revisit_bytes)
    fields = ["id", "uri", "payload_bytes", "payload_digest", "copies", "refers", "again"]
    kind = top.select(F.struct(*fields).alias("h")).schema["h"].dataType
    rows = (top.select("rec", F.lit(-1).alias("chunk"), F.struct(*fields).alias("head"),
                       F.lit(None).cast("binary").alias("data"))
            .unionByName(chunks.select("rec", "chunk", F.lit(None).cast(kind).alias("head"), "data")))
    return stored(rows.repartition("rec").sortWithinPartitions("rec", "chunk")
                  .mapInArrow(_write(folder, file_bytes), "path string, records long, bytes long"),
                  "warc-manifest")


def _fields(lines) -> dict[str, str]:
    out = {}
    for line in lines:
        k, _, v = line.partition(":")
        out[k.strip().lower()] = v.strip()
    return out


def _headers(f, path: str) -> list[str]:
    lines = []
    while (line := f.readline(1 << 20)) not in (b"\r\n", b"\n"):
        if not line.endswith(b"\n"):
            raise ValueError(f"{path}: a header without end")
        lines.append(line.decode("utf-8", "replace").rstrip("\r\n"))
    return lines


def records_of(path: str, stream, chunk_bytes: int = CHUNK_BYTES, data: bool = True):
    """Rows of the chunked record table of one archive, in order. Raises
    ValueError for what is no WARC record, or ends early."""
    f = gzip.GzipFile(fileobj=stream)
    while True:
        version = f.readline(64)
        if not version:
            return
        if not version.startswith(b"WARC/"):
            raise ValueError(f"{path}: not a WARC record: {version[:20]!r}")
        h = _fields(_headers(f, path))
        left, http, kind = int(h["content-length"]), {}, h.get("warc-type")
        if h.get("content-type", "").startswith("application/http"):
            at = f.tell()
            http = _fields(_headers(f, path)[1:])
            left -= f.tell() - at
        stated = http.get("content-length")
        digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
        ident = h.get("x-page-id")
        row = (path, h.get("warc-record-id"), kind, ident and unquote(ident), h.get("warc-target-uri"),
               h.get("warc-refers-to"), int(stated) if stated else None, digest)
        sha, size, n = hashlib.sha1(), 0, 0
        while True:
            part = f.read(min(left, chunk_bytes))
            if len(part) < min(left, chunk_bytes):
                raise ValueError(f"{path}: a record ends early")
            left -= len(part)
            size += len(part)
            sha.update(part)
            yield (*row, n, len(part), size, sha.hexdigest(), not left, *([part] if data else []))
            n += 1
            if not left:
                break
        if f.read(4) != b"\r\n\r\n":
            raise ValueError(f"{path}: a record without end")


def read_warc(spark: SparkSession, files: DataFrame, path_col: str = "path",
              chunk_bytes: int = CHUNK_BYTES, data: bool = True) -> DataFrame:
    """The chunked record table of the archives that `files` names, one row
    per chunk: what the record's header states (stated_bytes and stated_digest are
    of the payload), chunk number, bytes, and payload_bytes and payload_digest as
    carried so far, those of the payload where `last`. A task takes a file at a
    time and holds one chunk (`data` leaves the bytes out if false)."""
    paths = files.select(F.col(path_col).alias("path"))
    names = [c.split()[0] for c in (_CHUNK + ", data binary" * data).split(", ")]
    kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(),
                                 pa.string(), pa.bool_(), pa.binary()]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, at = _folder(path)
                with fs.open_input_stream(at, compression=None) as stream:
                    rows, held = [], 0
                    for row in records_of(path, stream, chunk_bytes, data):
                        rows.append(row)
                        held += row[9] if data else 0
                        if len(rows) >= _ROWS or held >= 4 << 20:
                            yield table(rows)
                            rows, held = [], 0
                    if rows:
                        yield table(rows)

    n = max(1, files.count())  # a task per file; files have about FILE_BYTES
    return paths.repartitionByRange(n, "path").mapInArrow(run, _CHUNK + ", data binary" * data)


def round_trip(records: DataFrame, id_col: str = "page_id", uri_col: str = "url",
               payload_col: str = "html", **options) -> DataFrame:
    """(`id_col`, payload_bytes, payload_digest, record_type, refers_to) per row
    of `records`, as archives say that were written and read back. Raises if a
    payload read differs from what its header states."""
    spark = records.sparkSession
    manifest = write_warc(records, scratch_path(spark, "llm", "warc"), id_col, uri_col,
                          payload_col, **options)
    chunk_bytes = options.get("chunk_bytes", CHUNK_BYTES)
    found = stored(read_warc(spark, manifest, chunk_bytes=chunk_bytes, data=False)
                   .where("last and warc_type <> 'warcinfo'"), "warc-records")
    whole = found.where("warc_type = 'response'").select(
        "record_id", "id", "refers_to", "warc_type",
        F.when((F.col("payload_bytes") == F.col("stated_bytes"))
               & (F.col("payload_digest") == F.col("stated_digest")), F.col("payload_bytes"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged record "), "record_id"))).alias("payload_bytes"),
        "payload_digest")
    again = found.where("warc_type = 'revisit'").select(
        "record_id", "id", "refers_to", "warc_type", F.col("stated_bytes").alias("payload_bytes"),
        F.col("stated_digest").alias("payload_digest"))
    target = whole.select(F.col("record_id").alias("refers_to"), F.col("id").alias("target"))
    kind = records.schema[id_col].dataType
    both = (whole.withColumn("target", F.lit(None).cast("string"))
            .unionByName(again.join(target, "refers_to", "left")))
    return both.select(F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest",
                       F.col("warc_type").alias("record_type"), F.col("target").cast(kind).alias("refers_to"))
