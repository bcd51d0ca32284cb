"""Zstandard WARC archives: a writer, and a reader that checks what it reads.

An archive is a file of Zstandard frames.  The leading skippable frame (type 13) holds the
dictionary, every further data frame one WARC record; other skippable frames are passed over.

Writing goes through Spark's text writer, which commits a task's files in one go and works with
every store Spark can write to: a row is a frame, and the line separator is an empty skippable
frame, so that the file is a plain sequence of frames.  Files are closed after a fixed number of
rows; a block that is full by bytes before that is filled up with empty rows.  An archive thus
holds a bounded number of records and bytes, and so does a writing or reading task.

Of records with equal payloads of at least ``least_bytes``, that with the largest id is a
``response``; the others are ``revisit`` records without payload that refer to it.

Defined results: a null payload is empty, a null url is left out; rows with a null id get the
record id ``none`` and come back with a null id; rows that tie on the largest id are all
responses; a record that breaks a rule comes back with ``error`` set and what could be read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.llm.common import staged, staged_path

LEAST_BYTES = 1000
RECORDS_PER_FILE = 2000
BYTES_PER_FILE = 16 << 20
DICTIONARY_BYTES = 32 << 10
TRAINING_BYTES = 1 << 20
LEVEL = 6

# Fixed values of the formats.
WARC_VERSION = "WARC/1.1"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATA_FRAME = 0xFD2FB528
SKIPPABLE = 0x184D2A50
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = 0xEC30A437
EMPTY_FRAME = "P*M\x18\0\0\0\0"  # a skippable frame without content, as text
DATE = "2020-01-01T00:00:00Z"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

READ_SCHEMA = ("id string, url string, record_type string, payload binary, payload_bytes long, "
               "payload_digest string, refers_to_id string, error string")


# ---------------------------------------------------------------------------------- records

def record_id(key) -> str:
    return "<urn:x-page:" + ("none" if key is None else "id:" + quote(str(key), safe="")) + ">"


def key_of(text: str | None) -> str | None:
    m = re.fullmatch(r"<urn:x-page:(?:none|id:(.*))>", text or "")
    return unquote(m[1]) if m and m[1] is not None else None


def make_record(key, url: str | None, payload: bytes, digest: str, target) -> bytes:
    """A response (``target`` null) or a revisit of the record of ``target``.  ``digest``: hex SHA-1."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if target is not None else http + payload
    head = [WARC_VERSION, "WARC-Type: " + ("response" if target is None else "revisit"),
            "WARC-Record-ID: " + record_id(key), "WARC-Date: " + DATE]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%:/?#[]@!$&'()*+,;=~"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if target is not None:
        head += ["WARC-Profile: " + IDENTICAL_PAYLOAD, "WARC-Refers-To: " + record_id(target)]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[str]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {line[:60]!r}")
        out[name.strip().lower()] = value.strip()
    return out


def _length(value: str, what: str) -> int:
    if not re.fullmatch(r"[0-9]+", value):
        raise ValueError(f"bad {what} {value[:40]!r}")
    return int(value)


def parse_record(data: bytes) -> tuple:
    """The columns of ``READ_SCHEMA`` of the one record that ``data`` must be."""
    got: dict = {}
    try:
        head, gap, rest = data.partition(b"\r\n\r\n")
        if not gap:
            raise ValueError("no end of the header")
        version, *lines = head.decode("utf-8").split("\r\n")
        if version not in ("WARC/1.0", "WARC/1.1"):
            raise ValueError(f"bad version {version[:40]!r}")
        f = _fields(lines)
        if missing := [n for n in REQUIRED if n.lower() not in f]:
            raise ValueError("missing " + ", ".join(missing))
        got |= {"id": key_of(f["warc-record-id"]), "record_type": f["warc-type"],
                "refers_to_id": key_of(f.get("warc-refers-to"))}
        got["url"] = f.get("warc-target-uri")
        size = _length(f["content-length"], "Content-Length")
        if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
            raise ValueError(f"Content-Length {size}, but {len(rest) - 4} bytes")
        if f["warc-type"] in ("response", "revisit"):
            http, gap, payload = rest[:size].partition(b"\r\n\r\n")
            if not gap or not http.startswith(b"HTTP/"):
                raise ValueError("no HTTP header")
            h = _fields(http.decode("latin-1").split("\r\n")[1:])
            said = _length(h.get("content-length", ""), "HTTP Content-Length")
            algorithm, _, digest = f.get("warc-payload-digest", "").partition(":")
            if algorithm != "sha1":
                raise ValueError("no SHA-1 payload digest")
            got |= {"payload_bytes": said, "payload_digest": base64.b32decode(digest).hex()}
            if f["warc-type"] == "revisit":
                if payload or "warc-refers-to" not in f:
                    raise ValueError("a revisit with payload or without reference")
            else:
                got["payload"] = payload
                if len(payload) != said:
                    raise ValueError(f"HTTP Content-Length {said}, but {len(payload)} bytes")
                if hashlib.sha1(payload).hexdigest() != got["payload_digest"]:
                    raise ValueError("payload digest does not match")
    except ValueError as e:  # also bad UTF-8 and bad base32
        got["error"] = str(e)[:200]
    return tuple(got.get(c.split()[0]) for c in READ_SCHEMA.split(", "))


# ----------------------------------------------------------------------------------- frames

def skippable(kind: int, content: bytes) -> bytes:
    return struct.pack("<II", kind, len(content)) + content


def frame_end(buf: memoryview, at: int) -> int:
    """Where the data frame at ``at`` ends; found from its block headers."""
    import zstandard

    head = bytes(buf[at:at + 18])
    params = zstandard.get_frame_parameters(head)
    p = at + zstandard.frame_header_size(head)
    while True:
        if p + 3 > len(buf):
            raise ValueError("a frame is cut off")
        h = int.from_bytes(buf[p:p + 3], "little")
        kind, size = (h >> 1) & 3, h >> 3
        if kind == 3:
            raise ValueError("bad block type")
        p += 3 + (1 if kind == 1 else size)
        if h & 1:
            break
    p += 4 * params.has_checksum
    if p > len(buf):
        raise ValueError("a frame is cut off")
    return p


def read_archive(content: bytes) -> Iterator[tuple]:
    """Records of one archive.  A frame that does not decode gives an error row; after a broken
    frame border the rest of the archive cannot be told apart and gives one error row."""
    import zstandard

    buf, at, dictionary, decoder = memoryview(content), 0, None, None
    failed = lambda e: (None,) * 7 + (str(e)[:200],)
    while at < len(buf):
        try:
            if at + 8 > len(buf):
                raise ValueError("a frame is cut off")
            magic, size = struct.unpack_from("<II", buf, at)
            if magic & 0xFFFFFFF0 == SKIPPABLE:
                end = at + 8 + size
                if end > len(buf):
                    raise ValueError("a frame is cut off")
                if magic == DICTIONARY_FRAME and at == 0:
                    raw = bytes(buf[8:end])
                    if raw[:4] == struct.pack("<I", DATA_FRAME):  # the dictionary may be compressed itself
                        raw = zstandard.ZstdDecompressor().decompress(raw)
                    dictionary = zstandard.ZstdCompressionDict(raw)
                at = end
                continue
            if magic != DATA_FRAME:
                raise ValueError("neither a data frame nor a skippable one")
            end = frame_end(buf, at)
        except (ValueError, zstandard.ZstdError) as e:
            yield failed(e)
            return
        try:
            decoder = decoder or zstandard.ZstdDecompressor(dict_data=dictionary)
            data = decoder.decompressobj().decompress(buf[at:end])
        except zstandard.ZstdError as e:
            yield failed(e)
        else:
            yield parse_record(data)
        at = end


def archive_frames(records: list[bytes], dictionary_bytes: int = DICTIONARY_BYTES,
                   training_bytes: int = TRAINING_BYTES, level: int = LEVEL) -> Iterator[bytes]:
    """The dictionary's frame (an empty one if there is too little to learn from), then one
    frame per record."""
    import zstandard

    sample, held = [], 0
    for r in records:
        if held >= training_bytes:
            break
        sample.append(r[:training_bytes - held])
        held += len(sample[-1])
    dictionary = None
    if len(sample) >= 16 and held >= 4 * dictionary_bytes:
        try:
            dictionary = zstandard.train_dictionary(dictionary_bytes, sample, k=256, d=8)
        except zstandard.ZstdError:
            pass  # too much alike to learn from: plain frames
    if dictionary:
        yield skippable(DICTIONARY_FRAME, zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes()))
        dictionary.precompute_compress(level=level)
        coder = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
    else:
        yield skippable(SKIPPABLE, b"")
        coder = zstandard.ZstdCompressor(level=level, write_checksum=True)
    for r in records:
        yield coder.compress(r)


# ------------------------------------------------------------------------------------ Spark

def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 body_col: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """id, url, payload, digest, target (the id that a revisit refers to, else null)."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(body_col).cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    # Written first, so that its size is known: small ones are broadcast by Spark's own threshold,
    # large ones joined by a shuffle that can be split where a payload is very common.
    heads = staged(rows.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes")
                   .agg(F.max("id").alias("head"), F.count("*").alias("n"))
                   .where("n > 1").select("digest", "bytes", "head"), "warc-heads")
    return rows.join(heads, ["digest", "bytes"], "left").select(
        "id", "url", "payload", "digest",
        F.when(~F.col("head").eqNullSafe(F.col("id")), F.col("head")).alias("target"))


def write_archives(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE,
                   bytes_per_file: int = BYTES_PER_FILE) -> None:
    """Write the rows of ``plan_records`` as archives under ``path``, any store Spark writes to."""
    def run(batches):
        held: list[bytes] = []
        size = 0

        def close(last: bool):
            frames = list(archive_frames(held))
            if not last:
                frames += [b""] * (records_per_file + 1 - len(frames))
            return pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c))
                    for c in ("id", "url", "payload", "digest", "target")]
            for i in range(batch.num_rows):
                r = make_record(*(c[i].as_py() for c in cols))
                if held and size + len(r) > bytes_per_file:
                    yield close(last=False)
                    held, size = [], 0
                held.append(r)
                size += len(r)
                if len(held) == records_per_file:
                    yield close(last=False)
                    held, size = [], 0
        if held:
            yield close(last=True)

    (records.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", records_per_file + 1).text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives under ``path`` (``READ_SCHEMA``)."""
    from termweave.llm.common import _arrow_schema
    from pyspark.sql.types import StructType

    schema = _arrow_schema(StructType.fromDDL(READ_SCHEMA))

    def run(batches):
        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            for content in b.column(0):
                rows, held = [], 0
                for r in read_archive(content.as_py()):
                    rows.append(r)
                    held += len(r[3] or b"")
                    if len(rows) >= 1000 or held > 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select("content").mapInArrow(run, READ_SCHEMA))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
               least_bytes: int = LEAST_BYTES, path: str | None = None) -> DataFrame:
    """Write the archives, read them back.  A record that breaks a rule stops the job."""
    spark = pages.sparkSession
    path = path or staged_path(spark, "warc")
    write_archives(plan_records(pages, id_col, url_col, body_col, least_bytes), path)
    kind = pages.schema[id_col].dataType
    back = read_archives(spark, path)
    bad = F.raise_error(F.concat(F.lit("bad record: "), F.col("error"))).cast("string")
    return back.select(F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest",
                       F.when(F.col("error").isNotNull(), bad).otherwise(F.col("record_type")).alias("record_type"),
                       F.col("refers_to_id").cast(kind).alias("refers_to"))
