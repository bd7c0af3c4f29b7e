"""Archives written and read back, chunk by chunk."""

import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from wagegrid.llm import warc


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) by a plain pass over (page_id, html)."""
    held = {}
    for page, html in rows:
        held.setdefault((html or "").encode(), []).append(page)
    out = []
    for data, ids in held.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        out += [(i, len(data), digest(data), "revisit", ids[-1]) for i in ids[:-1]]
        out.append((ids[-1], len(data), digest(data), "response", None))
    return sorted(out, key=repr)


LONG = "".join(chr(0x4E00 + i % 5000) for i in range(5_000))
ROWS = [
    (1, "<p>a</p>"), (2, "<p>a</p>"), (7, "<p>a</p>"), (3, None), (4, ""), (5, "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"),
    (6, LONG), (8, LONG), (9, LONG + "x"), (None, "<p>none</p>"), (None, "<p>a</p>"), (10, "twice"), (10, "twice"), (11, "\r\n" * 500),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://x.example/a b?q={i}é", h, "mine") for i, h in ROWS[:-1]] + [(*ROWS[-1][:1], None, ROWS[-1][1], "mine")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, record string").repartition(3).cache()


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 1000, 7])
def test_round_trip(spark, pages, tmp_path, chunk_bytes):
    got = warc.round_trip(pages, str(tmp_path / "w"), chunk_bytes=chunk_bytes, archive_bytes=2_000).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
    assert sorted(map(tuple, got.collect()), key=repr) == expected(ROWS)


def test_chunks_carry_digests_of_what_came_before(pages):
    rows = [r for r in warc.chunk_table(pages, chunk_bytes=1000).collect() if r.page_id == "6"]
    data = LONG.encode()
    assert [r.chunk for r in rows] == list(range(15)) and [r.last for r in rows] == [False] * 14 + [True]
    assert b"".join(bytes(r.data) for r in rows) == data
    assert all(r.digest == digest(data[: r.total]) for r in rows)


def test_archives_are_plain_warc(pages, tmp_path):
    manifest = warc.write_archives(pages, str(tmp_path / "w"), chunk_bytes=4_000).collect()
    text = b"".join(gzip.decompress(Path(r.path).read_bytes()) for r in manifest)
    assert sum(r.records for r in manifest) == text.count(b"\r\nWARC-Block-Digest:") + text.count(b"WARC-Type: revisit")
    assert text.count(LONG[:1000].encode()) == 2 and text.count(b"WARC-Segment-Origin-ID") == 6
    assert b"WARC-Target-URI: http://x.example/a%20b?q=1%C3%A9\r\n" in text
    first = Path(manifest[0].path).read_bytes()
    assert gzip.GzipFile(manifest[0].path).readline() == b"WARC/1.1\r\n" and first.count(b"\x1f\x8b\x08") > 1


def test_least_bytes_and_data(spark, pages, tmp_path):
    manifest = warc.write_archives(pages, str(tmp_path / "w"), least_bytes=9)
    chunks = warc.read_archives(manifest, chunk_bytes=500)
    kinds = {(r.page_id, r.record_type) for r in chunks.collect()}
    assert {("1", "response"), ("2", "response"), ("6", "revisit"), ("8", "response")} <= kinds
    long = sorted((r for r in chunks.collect() if r.page_id == "9"), key=lambda r: r.part)
    assert len(long) == 31 and b"".join(bytes(r.data) for r in long).decode() == LONG + "x"
    assert long[-1].digest == digest((LONG + "x").encode())


def test_damage_is_found(spark, pages, tmp_path):
    manifest = warc.write_archives(pages.where("page_id = 5"), str(tmp_path / "w"))
    path = Path(manifest.first().path)
    path.write_bytes(b"".join(gzip.compress(gzip.decompress(path.read_bytes()).replace(b"1.1\r\n\r\nWARC-Type", b"1.1\r\n\r\nwarc-type")) for _ in "1"))
    with pytest.raises(Exception, match="digest differs"):
        warc.read_records(warc.read_archives(manifest)).collect()


def test_no_pages(pages, tmp_path):
    assert warc.round_trip(pages.where("page_id < 0"), str(tmp_path / "w")).count() == 0


def test_many_groups_join_without_broadcast(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr("wagegrid.settings.small_side", lambda df, *_: df)
    got = warc.round_trip(pages, str(tmp_path / "w")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=repr) == expected(ROWS)
