"""WARC archives as a Python data source, reading and writing.

Writing: each task writes gzip archives, one gzip member per record, into
the target's staging folder; the commit moves the files of the attempts
that Spark accepted, so a lost executor or a speculative copy leaves
nothing behind. Every member carries its compressed and full size in a
gzip extra field ("sl"), so a reader can step over it without inflating.

Reading: the driver lists the files and plans partitions of whole files
(small files together). Equality, IN, prefix and null predicates on the
record type and on header columns are pushed down. A task inflates a
record's headers first; if they fail a pushed predicate, or the payload is
not asked for (option ``payload`` = ``false``), it seeks to the next record
without decoding the rest. Archives of other writers (members without the
size field, or plain ``.warc``) are read as well.

Response and revisit: of pages with equal payloads of at least
``min_payload`` bytes the one with the smallest id is a ``response``, the
others are ``revisit`` records that refer to it and hold no payload. Equal
means equal SHA-256 and length. Of rows that repeat that id with that
payload one is the response.

Edge cases: null html is an empty payload; a null page id sorts last and
its record has no number; page ids keep their type (text ids too); a null url has no target header; control characters in a url
are percent-encoded; an empty table writes no records and reads back as no
rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
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
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In,
                                    InputPartition, IsNotNull, IsNull, StringStartsWith, WriterCommitMessage)

from paylens.llm.common import materialise, scratch_path

FILE_BYTES, PLAN_BYTES, BATCH_BYTES = 256 << 20, 64 << 20, 4 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
           "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
           "payload_length": "X-Payload-Length", "content_length": "Content-Length"}
SCHEMA = ("warc_type string, record_id string, target_uri string, date string, payload_digest string, "
          "refers_to string, payload_length long, content_length long, payload binary")
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
_TYPES = [{"long": pa.int64(), "binary": pa.binary()}.get(c.split()[1], pa.string()) for c in SCHEMA.split(", ")]
_LONGS = ("payload_length", "content_length")


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder named by path or URI (file:, hdfs:, s3: ...)."""
    if re.match(r"file:/(?!/)", path):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def record_bytes(row: dict) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP headers only."""
    payload = row["payload"] or b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if row["warc_type"] == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {row['warc_type']}", f"WARC-Record-ID: <{_safe(row['record_id'])}>",
             f"WARC-Date: {row['date']}"]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_safe(row['target_uri'])}")
    if row["refers_to"] is not None:
        lines += [f"WARC-Refers-To: <{_safe(row['refers_to'])}>", f"WARC-Profile: {REVISIT}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"X-Payload-Length: {len(payload)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = 3) -> bytes:
    """A gzip member whose extra field "sl" holds its total and its inflated size."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    size = 12 + 20 + len(body) + 8
    extra = b"sl" + struct.pack("<HQQ", 16, size, len(record))
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF))


def parse_headers(head: bytes) -> dict:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    named = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if k}
    row = {c: named.get(h.lower()) for c, h in HEADERS.items()}
    for c in ("record_id", "refers_to"):
        row[c] = row[c].strip("<>") if row[c] else None
    for c in _LONGS:
        row[c] = int(row[c]) if row[c] is not None else None
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].partition(":")[2] or row["payload_digest"]
    return row


def _payload(row: dict, block: bytes, verify: bool) -> bytes | None:
    if row["warc_type"] == "revisit":
        return None
    payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
    if verify and row["payload_digest"] and digest_of(payload) != row["payload_digest"]:
        raise ValueError(f"payload digest of {row['record_id']} does not match")
    return payload


def scan(f, wanted, with_payload: bool, verify: bool = True) -> Iterator[dict]:
    """Records of an open archive whose headers satisfy ``wanted``."""
    size, at = f.size(), 0
    while at < size:
        f.seek(at)
        lead = f.read(12)
        if lead[:2] != b"\x1f\x8b":                        # plain records
            f.seek(at)
            head = b""
            while b"\r\n\r\n" not in head and (more := f.read(4096)):
                head += more
            cut = head.index(b"\r\n\r\n") + 4
            row = parse_headers(head[:cut - 4])
            start, at = at + cut, at + cut + row["content_length"] + 4
            if not wanted(row):
                continue
            block = b""
            if with_payload and row["warc_type"] != "revisit":
                f.seek(start)
                block = f.read(row["content_length"])
        else:
            total, begin = None, at
            if lead[3] == 4:
                extra = f.read(struct.unpack("<H", lead[10:12])[0])
                if extra[:2] == b"sl":
                    total = struct.unpack("<HQQ", extra[2:20])[1]
            inflate = zlib.decompressobj(-15 if total else 31)
            f.seek(begin + 12 + len(extra) if total else begin)
            head = b""
            while b"\r\n\r\n" not in head and not inflate.eof:
                more = f.read(2048) if not inflate.unconsumed_tail else b""
                head += inflate.decompress(inflate.unconsumed_tail + more, 4096)
                if not more and not inflate.unconsumed_tail:
                    break
            cut = head.index(b"\r\n\r\n") + 4
            row = parse_headers(head[:cut - 4])
            keep = wanted(row)
            block, need = head[cut:], keep and with_payload and row["warc_type"] != "revisit"
            if need or not total:                          # without a size field a member must be inflated to find its end
                parts = [block]
                while not inflate.eof and (more := inflate.unconsumed_tail or f.read(1 << 16)):
                    parts.append(inflate.decompress(more))
                block = b"".join(parts)[: row["content_length"]]
            at = begin + total if total else f.tell() - len(inflate.unused_data)
            if not keep:
                continue
        row["payload"] = _payload(row, block, verify) if with_payload else None
        yield row


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; options payload and verify (true)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"])


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.with_payload = str(options.get("payload", "true")).lower() == "true"
        self.verify = str(options.get("verify", "true")).lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            kind = {EqualTo: "eq", EqualNullSafe: "same", In: "in", StringStartsWith: "prefix", IsNotNull: "some",
                    IsNull: "none"}.get(type(f))
            if kind is None or column not in HEADERS:
                yield f
                continue
            value = getattr(f, "value", None)
            self.tests.append((column, kind, frozenset(value) if kind == "in" else value))

    def wanted(self, row: dict) -> bool:
        for column, kind, value in self.tests:
            have = row[column]
            ok = {"eq": have is not None and have == value, "same": have == value, "none": have is None,
                  "some": have is not None, "in": have is not None and kind == "in" and have in value,
                  "prefix": have is not None and kind == "prefix" and have.startswith(value)}[kind]
            if not ok:
                return False
        return True

    def partitions(self):
        fs, root = open_path(self.path)
        infos = [i for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
                 if i.is_file and re.search(r"\.warc(\.gz)?$", i.base_name)]
        plan, held, size = [], [], 0
        for i in sorted(infos, key=lambda i: i.path):
            if held and size + i.size > PLAN_BYTES:
                plan.append(Files(held))
                held, size = [], 0
            held.append(i.path)
            size += i.size
        return plan + [Files(held)]

    def read(self, partition):
        fs, _ = open_path(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as f:
                for row in scan(f, self.wanted, self.with_payload, self.verify):
                    rows.append(row)
                    size += 200 + len(row["payload"] or b"")
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(_COLUMNS, _TYPES)], _COLUMNS)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.staging = path, f"_staging-{uuid.uuid4().hex}"   # of this write alone

    def write(self, iterator):
        fs, root = open_path(self.path)
        fs.create_dir(f"{root}/{self.staging}", recursive=True)
        files, out, size = [], None, 0
        task = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name = f"part-{task}-{len(files):04d}.warc.gz"
                    files.append((f"{root}/{self.staging}/{name}", f"{root}/{name}"))
                    out, size = fs.open_output_stream(files[-1][0], compression=None), 0
                member = gzip_member(record_bytes(row))
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages):
        fs, root = open_path(self.path)
        fs.create_dir(root, recursive=True)
        for m in messages:
            for staged, final in (m.files if m else []):
                fs.move(staged, final)
        self._clear(fs, root)

    def abort(self, messages):
        self._clear(*open_path(self.path))

    def _clear(self, fs, root):
        if fs.get_file_info(f"{root}/{self.staging}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/{self.staging}")


def records(pages: DataFrame, min_payload: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Pages (page_id, url, html) as rows to write: response or revisit."""
    base = pages.select("page_id", F.col("url").cast("string").alias("target_uri"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    # written once: the row numbers that tell repeated rows apart are the same in both readings
    base = materialise(base.withColumn("key", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
                       .withColumn("rid", F.monotonically_increasing_id()), "warc-pages")
    own = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("id"), F.col("rid").alias("rid"))
    first = (base.filter(F.col("size") >= min_payload).groupBy("key", "size").agg(F.min(own).alias("f"), F.count("*").alias("n"))
             .filter("n > 1"))
    # narrow rows find their payload's first; only the revisits' answers meet the payloads, by row number
    again = materialise(base.select("rid", "key", "size").join(first, ["key", "size"]).filter("rid <> f.rid")
                        .select("rid", F.lit(True).alias("again"), F.col("f.id").alias("first")), "warc-again")
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return base.join(again, "rid", "left").select(
        F.when(F.col("again"), "revisit").otherwise("response").alias("warc_type"), urn("page_id").alias("record_id"),
        "target_uri", F.lit(date).alias("date"), F.when(F.col("again"), urn("first")).alias("refers_to"), "payload")


def write_archives(pages: DataFrame, path: str, min_payload: int = 0) -> None:
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    records(pages, min_payload).write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True, verify: bool = True) -> DataFrame:
    """Records of the archives in a folder; filters on header columns are pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return (spark.read.format("warc").option("payload", str(payload).lower()).option("verify", str(verify).lower())
            .load(path))


def round_trip(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Write ``pages`` to archives and read them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to. Responses are decoded and their
    digests verified; revisits are read by their headers alone."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_payload)
    kind = pages.schema["page_id"].dataType.simpleString()
    number = lambda c: F.expr(f"try_cast(nullif(substring({c}, 10), '') AS {kind})")
    responses = read_archives(spark, path).filter("warc_type = 'response'")
    revisits = read_archives(spark, path, payload=False).filter("warc_type = 'revisit'")
    return (responses.select("*", F.octet_length("payload").cast("long").alias("bytes"))
            .unionByName(revisits.select("*", F.col("payload_length").alias("bytes")))
            .select(number("record_id").alias("page_id"), F.col("bytes").alias("payload_bytes"), "payload_digest",
                    F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to")))
