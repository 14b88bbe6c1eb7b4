"""WARC archives through a chunked record table.

A payload is a run of rows ``record, chunk number, bytes`` of at most ``CHUNK``
bytes from the scan on: the shuffle that groups a record's chunks, the writer
and the reader each hold a few chunks at a time, never a whole payload beyond
the input row itself. Digests are carried along: the writer checks the running
SHA-1 of the chunks against the digest in the header, and the reader gives each
chunk row the digest of the payload up to its end.

Archives are gzip files with one member per record. A task writes to a name of
its own attempt and reports the finished file as a manifest row; only files in
the manifest are read, so a lost or repeated task leaves nothing that counts.

Records with equal payloads of at least ``min_bytes`` bytes: the one with the
smallest id is a ``response``, the others ``revisit`` it. Null payloads are
empty. Null ids come after all others and are ``null`` in record names;
repeated rows are records of their own, the second of them revisits the first
(below ``min_bytes`` both are responses). An empty table gives no archive and no
rows. Columns other than id, address and payload are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, materialize, salted_join

CHUNK = 64 << 10
FILE_BYTES = 256 << 20      # compressed size at which a task starts another file
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = ("record string, type string, uri string, digest string, refers_to string, payload_bytes long, "
               "chunk int, size long, running string, data binary")


def base32(hexa: str) -> str:
    return base64.b32encode(bytes.fromhex(hexa)).decode()


def chunks(pages: DataFrame, id_col: str = "page_id", uri: str = "url", payload: str = "html",
           chunk: int = CHUNK) -> DataFrame:
    """Chunk rows ``id, uri, row, bytes, sha1, chunk, data`` of every payload;
    an empty payload has one empty chunk."""
    p = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    d = pages.select(F.col(id_col).alias("id"), F.col(uri).alias("uri"), p.alias("p"),
                     F.monotonically_increasing_id().alias("row"))
    d = d.select("id", "uri", "row", "p", F.octet_length("p").cast("long").alias("bytes"), F.sha1("p").alias("sha1"))
    last = F.greatest(F.lit(0), F.ceil(F.col("bytes") / F.lit(chunk)).cast("int") - 1)
    d = d.withColumn("chunk", F.explode(F.sequence(F.lit(0), last)))
    return d.select("id", "uri", "row", "bytes", "sha1", "chunk",
                    F.substring("p", F.col("chunk") * chunk + 1, F.lit(chunk)).alias("data"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", uri: str = "url", payload: str = "html",
          min_bytes: int = 0, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives below ``path`` (a folder all executors share) and
    return their manifest ``path, records, size``."""
    arrow_rows(pages.sparkSession, 128)
    narrow = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
                          .alias("p")).filter(F.octet_length("p") >= min_bytes).select("id", F.sha1("p").alias("sha1"))
    same = narrow.groupBy("sha1").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    same = salted_join(narrow, same, ["sha1"], ["id"]).select(_key().alias("key"), "id", "first").distinct()
    same = same.select("key", "first", (~F.col("id").eqNullSafe(F.col("first"))).alias("other"), F.lit(True).alias("shared"))
    # payloads are shuffled once; the join takes that partitioning
    rows = chunks(pages, id_col, uri, payload, chunk).withColumn("key", _key()).repartition("key").join(same, "key", "left")
    rows = rows.withColumn("revisit", F.coalesce("other", F.lit(False))).filter("chunk = 0 or not revisit")
    rows = rows.select(F.col("id").cast("string").alias("id"), "uri", "row", "bytes", "sha1", "chunk", "revisit",
                       F.coalesce("shared", F.lit(False)).alias("shared"), F.col("first").cast("string").alias("first"),
                       F.when(~F.col("revisit"), F.col("data")).alias("data"))
    rows = rows.sortWithinPartitions("id", "sha1", "row", "chunk")
    return materialize(rows.mapInArrow(_writer(path, file_bytes), "path string, records long, size long"), "manifest")


def _key():
    return F.concat_ws("/", F.coalesce(F.col("id").cast("string"), F.lit("null")), "sha1")


def _uri(path: str) -> str:
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def _open(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(_uri(path))


def record_name(ident: str | None, sha1: str, copy: int) -> str:
    return f"<urn:page:{'null' if ident is None else ident}/{base32(sha1)}/{copy}>"


def header(name: str, uri: str | None, sha1: str, size: int, refers_to: str | None) -> bytes:
    """WARC and HTTP header of a record with a payload of ``size`` bytes."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = "".join(c if c > " " and c not in "<>" else "%%%02X" % ord(c) for c in uri or "about:blank")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {name}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base32(sha1)}",
             "Content-Type: application/http;msgtype=response"]
    if refers_to:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers_to}"]
    lines += [f"Content-Length: {len(http) + (0 if refers_to else size)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


class _Archive:
    """The archive files that one task writes, record by record."""

    def __init__(self, path: str, limit: int):
        self.path, self.limit, self.out, self.done = path.rstrip("/"), limit, None, []

    def begin(self, head: bytes, sha1: str | None):
        if self.out is None:
            self.name = f"{self.path}/{uuid.uuid4().hex}.warc.gz"
            fs, at = _open(self.name)
            fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
            self.out, self.records, self.size = fs.open_output_stream(at, compression=None), 0, 0
        self.zip, self.sum, self.sha1 = zlib.compressobj(1, zlib.DEFLATED, 31), hashlib.sha1(), sha1
        self._put(self.zip.compress(head))

    def _put(self, b: bytes):
        if b:
            self.out.write(b)
            self.size += len(b)

    def add(self, data: bytes):
        self.sum.update(data)
        self._put(self.zip.compress(data))

    def end(self):
        if self.sha1 and self.sum.hexdigest() != self.sha1:
            raise ValueError("a record's chunks do not give its payload digest")
        self._put(self.zip.compress(b"\r\n\r\n"))
        self._put(self.zip.flush())
        self.records += 1
        if self.size >= self.limit:
            self.close()

    def close(self):
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.records, self.size))
            self.out = None


def _writer(path: str, limit: int):
    def run(batches):
        files, open_row, skip, last, copy = _Archive(path, limit), None, False, None, 0
        for batch in batches:
            col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            meta = {c: col[c].to_pylist() for c in col if c != "data"}
            for i in range(batch.num_rows):
                row = meta["row"][i]
                if row != open_row:                     # another record starts
                    if open_row is not None:
                        files.end()
                    key = (meta["id"][i], meta["sha1"][i])
                    copy = copy + 1 if key == last else 0
                    last, open_row = key, row
                    again = meta["shared"][i] and copy > 0
                    skip = meta["revisit"][i] or again
                    refers = record_name(meta["first"][i], key[1], 0) if skip else None
                    files.begin(header(record_name(*key, copy), meta["uri"][i], key[1], meta["bytes"][i], refers),
                                None if skip else key[1])
                if not skip:
                    files.add(col["data"][i].as_py() or b"")
        if open_row is not None:
            files.end()
        files.close()
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in files.done], pa.string()),
                                          pa.array([f[1] for f in files.done], pa.int64()),
                                          pa.array([f[2] for f in files.done], pa.int64())],
                                         ["path", "records", "size"])
    return run


class _Bytes:
    """The unzipped bytes of an archive, read piece by piece."""

    def __init__(self, stream, piece: int = 1 << 16):
        self.stream, self.piece, self.buf, self.zip, self.raw = stream, piece, bytearray(), zlib.decompressobj(31), b""

    def _more(self) -> bool:
        while True:
            if self.zip.eof:
                self.raw, self.zip = self.zip.unused_data, zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.stream.read(self.piece)
                if not self.raw:
                    return False
            got = self.zip.decompress(self.raw, self.piece)
            self.raw = b"" if self.zip.eof else self.zip.unconsumed_tail
            if got:
                self.buf += got
                return True

    def until(self, end: bytes, limit: int = 1 << 20) -> bytes | None:
        while (k := self.buf.find(end)) < 0:
            if len(self.buf) > limit:
                raise ValueError("a header is too long")
            if not self._more():
                if self.buf:
                    raise ValueError("the archive ends within a record")
                return None
        out = bytes(self.buf[:k])
        del self.buf[:k + len(end)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) < n and self._more():
            pass
        if len(self.buf) < n:
            raise ValueError("the archive ends within a record")
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out


def records(stream, chunk: int = CHUNK) -> Iterator[tuple]:
    """Chunk rows of an archive, as in ``READ_SCHEMA``."""
    b = _Bytes(stream)
    while (head := b.until(b"\r\n\r\n")) is not None:
        lines = head.decode().split("\r\n")
        h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(h["content-length"])
        http = b.until(b"\r\n\r\n")
        size = length - len(http) - 4
        told = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        digest = h["warc-payload-digest"].partition(":")[2]
        kind, total, n, running = h["warc-type"], hashlib.sha1(), 0, None
        while n == 0 or size > 0:
            data = b.take(min(size, chunk))
            size -= len(data)
            total.update(data)
            running = base64.b32encode(total.digest()).decode()
            yield (h["warc-record-id"], kind, h.get("warc-target-uri"), digest, h.get("warc-refers-to"), told, n,
                   len(data), running, data)
            n += 1
        if kind == "response" and running != digest:
            raise ValueError(f"{h['warc-record-id']}: the payload does not have its digest")
        if b.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")


def read(spark: SparkSession, manifest: DataFrame, payload: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of all records of the archives in a manifest (``READ_SCHEMA``);
    without ``payload`` the ``data`` column is null."""
    schema = [f.name for f in spark.createDataFrame([], READ_SCHEMA).schema]
    types = [pa.string()] * 5 + [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], schema)

    def run(batches):
        for part in batches:
            for path in part.column(0).to_pylist():
                fs, at = _open(path)
                rows, size = [], 0
                with fs.open_input_stream(at, compression=None) as stream:
                    for r in records(stream, chunk):
                        rows.append(r if payload else (*r[:9], None))
                        size += r[7] + 200
                        if size > (4 << 20) or len(rows) >= 5000:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(run, READ_SCHEMA)      # a task per archive


def report(chunk_rows: DataFrame, id_type: str = "long", id_col: str = "page_id") -> DataFrame:
    """One row per record: id, size and digest of the full payload, record
    type, and the id that a revisit refers to."""
    def ident(c):
        return F.regexp_extract(c, r"^<urn:page:(.*)/[A-Z2-7]+/[0-9]+>$", 1).cast("string")
    g = chunk_rows.groupBy("record", "type", "digest", "refers_to").agg(
        F.max("payload_bytes").alias("told"), F.sum("size").alias("size"), F.max_by("running", "chunk").alias("running"))
    first = F.col("type") == "response"

    def typed(c):
        return F.when(ident(c) != "null", ident(c)).cast(id_type)
    return g.select(typed(F.col("record")).alias(id_col), F.when(first, F.col("size")).otherwise(F.col("told"))
                    .alias("payload_bytes"), F.when(first, F.col("running")).otherwise(F.col("digest"))
                    .alias("payload_digest"), F.col("type").alias("record_type"),
                    F.when(~first, typed(F.col("refers_to"))).alias("refers_to"))
