"""WARC archives as a PySpark Python data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans partitions over whole files (small ones together), pushes predicates on the record type and on header
fields into the scan, parses a record's header first and seeks past the payload of a record that is not wanted (or of
all records with option ``payload`` = false).  Plain ``.warc`` files and ``.warc.gz`` files with a gzip member per record are
read; members that carry their length in an ``sl`` extra field, as the writer's do, are skipped without inflating them.

Writing makes files of a gzip member per record, each task under names of its own; the commit lists them in a
manifest, so files of failed or repeated attempts are never read.  Paths are URIs that pyarrow's file systems open.

Defined results: a null payload is empty; null header fields are left out; control characters in header values are
percent-encoded; records with a header that can't be parsed end the task with an error; repeated rows are repeated
records; an empty table gives an empty archive, which reads back as no rows.
"""

from __future__ import annotations

import datetime as dt
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage

SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
          "content_length bigint, headers map<string,string>, payload binary")
FIELDS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
          "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
MANIFEST, FILE_BYTES, PLAN_BYTES, BATCH_BYTES, HEAD_BYTES = "manifest.txt", 64 << 20, 64 << 20, 4 << 20, 4096
MIN_REVISIT = 100


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri)


# ---- records


def _value(v) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(v))


def pack(headers: list[tuple[str, object]], body: bytes, level: int = 1) -> bytes:
    """One record as a gzip member whose extra field ``sl`` tells its length."""
    lines = [f"{k}: {_value(v)}" for k, v in headers if v is not None]
    raw = ("WARC/1.1\r\n" + "".join(x + "\r\n" for x in lines) + f"Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    deflated = z.compress(raw) + z.flush()
    size = 24 + len(deflated) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF if size < 1 << 32 else 0, len(raw) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + deflated \
        + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def _parse(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
    out: dict[str, str] = {}
    last = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            out[last] = value.strip()
    return out


def _plain(f, size: int, wanted, payload: bool):
    at = 0
    while at < size:
        f.seek(at)
        head = b""
        while b"\r\n\r\n" not in head and (more := f.read(HEAD_BYTES)):
            head += more
        end = head.find(b"\r\n\r\n")
        if not head.strip():
            return
        headers = _parse(head[:end].lstrip(b"\r\n"))
        n, start = int(headers["content-length"]), at + end + 4
        if wanted(headers):
            body = None
            if payload:
                f.seek(start)
                body = f.read(n)
            yield headers, body
        at = start + n + 4


def _members(f, size: int, wanted, payload: bool):
    at = 0
    while at < size:
        f.seek(at)
        buf = f.read(HEAD_BYTES)
        length = 0
        if buf[:4] == b"\x1f\x8b\x08\x04" and len(buf) >= 24:
            pos, stop = 12, 12 + struct.unpack("<H", buf[10:12])[0]
            while pos + 4 <= stop:
                kind, n = buf[pos:pos + 2], struct.unpack("<H", buf[pos + 2:pos + 4])[0]
                if kind == b"sl" and n == 8:
                    length = struct.unpack("<I", buf[pos + 4:pos + 8])[0]
                pos += 4 + n
        z, raw, took = zlib.decompressobj(31), b"", 0

        def inflate(most: int):  # reads on while the member lasts
            nonlocal buf, raw, took
            while not z.eof and b"\r\n\r\n" not in raw[:most] and len(raw) < most or (most < 0 and not z.eof):
                piece = z.unconsumed_tail or buf
                if not piece:
                    buf = f.read(1 << 20)
                    if not buf:
                        raise ValueError("the archive ends inside a record")
                    continue
                if piece is buf:
                    took, buf = took + len(buf), b""
                raw += z.decompress(piece, HEAD_BYTES if most >= 0 else 0)

        inflate(1 << 30)  # to the end of the header
        end = raw.find(b"\r\n\r\n")
        headers = _parse(raw[:end])
        take = wanted(headers)
        if take and payload or not length:
            inflate(-1)
        if take:
            n = int(headers["content-length"])
            yield headers, raw[end + 4:end + 4 + n] if payload else None
        at += length or took - len(z.unused_data)


def records(path: str, wanted=lambda h: True, payload: bool = True):
    """(headers with lower-case names, payload or None) of the records of one file that are wanted."""
    fs, p = _open(path)
    size = fs.get_file_info(p).size
    with fs.open_input_file(p) as f:
        zipped = f.read(2) == b"\x1f\x8b"
        yield from (_members if zipped else _plain)(f, size, wanted, payload)


# ---- the data source


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.payload = options["path"], str(options.get("payload", "true")).lower() != "false"
        self.tests: list[tuple[str, str, list]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in FIELDS and isinstance(f, EqualTo):
                self.tests.append((FIELDS[name], "in", [f.value]))
            elif name in FIELDS and isinstance(f, In):
                self.tests.append((FIELDS[name], "in", list(f.value)))
            elif name in FIELDS and isinstance(f, StringStartsWith):
                self.tests.append((FIELDS[name], "starts", [f.value]))
            else:
                yield f

    def wanted(self, headers: dict[str, str]) -> bool:
        return all((v := headers.get(k)) is not None and (v in given if how == "in" else v.startswith(given[0])) for k, how, given in self.tests)

    def partitions(self):
        """Whole files, small ones together; a manifest names the files, else all WARC files below the path."""
        fs, p = _open(self.path)
        info = fs.get_file_info(p)
        if info.type == pafs.FileType.File:
            return [Files([self.path])]
        root, found = self.path.rstrip("/"), []
        if fs.get_file_info(f"{p}/{MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{p}/{MANIFEST}") as f:
                for line in f.read().decode().splitlines():
                    name, size = line.split("\t")
                    found.append((f"{root}/{name}", int(size)))
        else:
            base = fs.get_file_info(pafs.FileSelector(p, recursive=True))
            found = [(f"{root}/{x.path[len(p.rstrip('/')) + 1:]}", x.size) for x in base if re.search(r"\.warc(\.gz)?$", x.path)]
        plans, room = [], 0
        for path, size in sorted(found):
            if not plans or room < size:
                plans.append([])
                room = PLAN_BYTES
            plans[-1].append(path)
            room -= size
        return [Files(x) for x in plans] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for path in partition.paths:
            for h, body in records(path, self.wanted, self.payload):
                rows.append((h, body))
                held += len(body or b"") + 500
                if held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows) -> pa.RecordBatch:
    cols = {k: pa.array([h.get(v) for h, _ in rows], pa.string()) for k, v in FIELDS.items()}
    cols["content_length"] = pa.array([int(h["content-length"]) for h, _ in rows], pa.int64())
    cols["headers"] = pa.array([list(h.items()) for h, _ in rows], pa.map_(pa.string(), pa.string()))
    cols["payload"] = pa.array([b for _, b in rows], pa.binary())
    return pa.RecordBatch.from_pydict(cols)


class WarcWriter(DataSourceArrowWriter):
    """Takes columns record_id, record_type, target_uri, refers_to, payload_digest, headers and payload; all but
    record_id, record_type and payload may be missing."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")

    def write(self, iterator) -> Written:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        part, files, out, size = TaskContext.get().partitionId(), [], None, 0
        now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        for batch in iterator:
            names = batch.schema.names
            for row in batch.to_pylist():
                if out is None:
                    name, size = f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", now)]
                head += [(label, row[c]) for c, label in (("target_uri", "WARC-Target-URI"), ("refers_to", "WARC-Refers-To"),
                                                          ("payload_digest", "WARC-Payload-Digest")) if c in names]
                head += list(row.get("headers") or [])
                size += out.write(pack(head, row["payload"] or b""))
                if size >= FILE_BYTES:
                    out.close()
                    files, out = files + [(name, size)], None
        if out is not None:
            out.close()
            files.append((name, size))
        return Written(files)

    def commit(self, messages) -> None:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write("".join(f"{n}\t{s}\n" for m in messages if m for n, s in m.files).encode())

    def abort(self, messages) -> None:
        fs, root = _open(self.path)
        for m in messages:
            for n, _ in m.files if m else []:
                fs.delete_file(f"{root}/{n}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets Spark push predicates into Python data sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archive(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> None:
    """Writes a record per row of pages (page_id, url, html).  Of equal payloads of at least min_revisit bytes the
    smallest page_id is the response and other pages revisit it; rows of that same page_id are responses too."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"digest": F.sha2("payload", 256), "n": F.octet_length("payload").cast("long")})
    firsts = rows.where(F.col("n") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies")) \
        .where(F.col("copies") > 1).select("digest", "first_id")
    rows = rows.join(firsts, "digest", "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull(), F.lit(False))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    out = rows.select(
        urn("page_id").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"), F.when(revisit, urn("first_id")).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.create_map(F.lit("WARC-Payload-Length"), F.col("n").cast("string")).alias("headers"),
        F.when(~revisit, F.col("payload")).alias("payload"))
    register(pages.sparkSession)
    out.write.format("warc").mode("append").save(path)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """What an archive of pages holds, a row per page; payloads of responses are read and digested again."""
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d*)>$", 1).try_cast("long")
    full = read(spark, path).where(F.col("record_type") == "response").select(
        page("record_id").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    heads = read(spark, path, payload=False).where(F.col("record_type") == "revisit").select(
        page("record_id").alias("page_id"), F.col("headers")["warc-payload-length"].cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"))
    return full.unionByName(heads)
