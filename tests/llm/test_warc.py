"""Archives: round trip, revisits, and what the reader refuses."""

import glob
import hashlib
import struct

import pytest
import zstandard
from llm_data import SMALL

from termweave.llm import queries, warc_zstd


def brute(pages, least=1000):
    heads = {}
    for i, h in pages:
        b = (h or "").encode()
        if len(b) >= least and i is not None:
            heads[b] = max(heads.get(b, i), i)
    out = []
    for i, h in pages:
        b = (h or "").encode()
        to = heads.get(b) if len(b) >= least else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if to in (None, i) else "revisit",
                    None if to == i else to))
    return sorted(out, key=str)


def test_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html").collect()]
    assert sorted(map(tuple, queries.op10_warc_zstd(spark, SMALL).collect()), key=str) == brute(pages)


@pytest.fixture(scope="module")
def odd_pages(spark):
    big, big2 = "<p>é" * 400, "x" * 1000
    rows = [(1, "http://a/é b\r\nX: y", big), (2, None, big), (3, "u", big), (3, "u", big), (4, "u", "short"),
            (5, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", big2), (9, "u", big2[:-1]), (10, "u", big2),
            (11, "u", "\r\n\r\nWARC/1.1\r\n" * 200), (None, "u", big)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_revisits(odd_pages, spark):
    got = sorted(map(tuple, warc_zstd.round_trip(odd_pages).collect()), key=str)
    assert got == brute([(r["page_id"], r["html"]) for r in odd_pages.collect()])
    assert warc_zstd.round_trip(odd_pages.limit(0)).count() == 0


def test_archives_are_files_of_one_frame_per_record(spark, odd_pages, tmp_path):
    path = str(tmp_path / "warc")
    many = spark.range(300).selectExpr("id as page_id", "concat('http://h/', id) url",
                                       "concat('<html><body>', repeat(concat('text ', id, ' of a page '), 80)) html")
    warc_zstd.write_archives(warc_zstd.plan_records(many.coalesce(1)), path, records_per_file=100)
    files = sorted(glob.glob(f"{path}/part-*"))
    assert len(files) == 3
    for f in files:
        data = open(f, "rb").read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D
        d = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + size]))
        # A plain streaming decoder reads the whole file, skippable frames included.
        text = zstandard.ZstdDecompressor(dict_data=d).stream_reader(data[8 + size:], read_across_frames=True).read()
        assert text.count(b"WARC/1.1\r\n") == 100
        assert len(list(warc_zstd.read_archive(data))) == 100
    got = warc_zstd.read_archives(spark, path)
    assert got.where("error is not null").count() == 0
    assert sorted(int(r["id"]) for r in got.collect()) == list(range(300))


def test_full_blocks_close_files(spark, tmp_path):
    path = str(tmp_path / "warc")
    pages = spark.range(40).selectExpr("id as page_id", "'u' url", "repeat(cast(id as string), 3000) html").coalesce(1)
    warc_zstd.write_archives(warc_zstd.plan_records(pages), path, records_per_file=20, bytes_per_file=20_000)
    assert len(glob.glob(f"{path}/part-*")) > 5
    assert warc_zstd.read_archives(spark, path).where("error is null").count() == 40


def broken():
    ok = warc_zstd.make_record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    yield ok, None
    yield ok.replace(b"WARC/1.1", b"WARC/9.9"), "version"
    yield ok.replace(b"WARC-Date: 2020-01-01T00:00:00Z\r\n", b""), "missing WARC-Date"
    yield ok + b"x", "Content-Length"
    yield ok.replace(b"payload\r\n", b"pAyload\r\n"), "digest"
    yield ok.replace(b"Content-Length: 7", b"Content-Length: 8"), "HTTP Content-Length"
    yield ok.replace(b"Content-Type: app", b"Content-Type app"), "bad header line"
    yield b"", "no end of the header"


def test_reader_validates():
    for data, error in broken():
        got = warc_zstd.parse_record(data)
        assert (got[-1] is None) if error is None else (error in got[-1])
    good = list(broken())[0][0]
    frames = list(warc_zstd.archive_frames([good] * 3))
    whole = b"".join(frames)
    assert [r[-1] for r in warc_zstd.read_archive(whole)] == [None] * 3
    cut = list(warc_zstd.read_archive(whole[:-3]))
    assert [r[-1] for r in cut] == [None, None, "a frame is cut off"]
    flipped = bytearray(whole)
    flipped[-6] ^= 0xFF  # inside the last frame: its checksum does not hold
    assert list(warc_zstd.read_archive(bytes(flipped)))[-1][-1]
    assert "neither" in list(warc_zstd.read_archive(b"garbage!!" * 3))[0][-1]
    assert list(warc_zstd.read_archive(b"")) == []
