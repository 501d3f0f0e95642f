import base64
import hashlib
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from ledgerlens.llm import warc as W
from ledgerlens.llm.common import scratch

SCHEMA = "page_id long, url string, html string, sha string, lang string"


def pages(spark, rows, n=3):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(n)


ROWS = [(1, "u1", "a" * 100), (2, "u2", "a" * 100), (2, "u2", "a" * 100), (None, None, None), (5, "x\ny%\r", ""), (None, "z: é", "é\r\n\r\nWARC/1.1"), (7, "p", "q"), (8, "", "a" * 100)]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark):
    got = W.warc_round_trip(pages(spark, ROWS)).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == sorted((str(i), len((h or "").encode()), digest(h)) for i, _, h in ROWS)
    by = {}
    for r in got:
        by.setdefault(r.payload_digest, []).append(r)
    for same in by.values():
        best = max((r.page_id for r in same), key=lambda i: (i is not None, i or 0))
        assert {r.page_id for r in same if r.record_type == "response"} == {best}
        assert all(r.record_type == "response" for r in same if r.page_id == best)
        assert all(r.record_type == "response" and r.refers_to is None or r.refers_to == best for r in same)


def test_payloads_and_urls_come_back(spark):
    folder = scratch(spark, "test-warc")
    got = W.read_archives(W.write_archives(pages(spark, ROWS), folder)).collect()
    assert sorted(map(str, (r.url for r in got))) == sorted(map(str, (u for _, u, _ in ROWS)))
    for r in got:
        if r.record_type == "response":
            assert digest(bytes(r.payload).decode()) == r.payload_digest


def test_small_payloads_are_never_revisits(spark):
    got = W.warc_round_trip(pages(spark, ROWS), min_bytes=50).collect()
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 50)
    assert sum(r.record_type == "revisit" for r in got) == 3  # pages 1, 2, 2 of the group that page 8 answers


def test_files_have_a_dictionary_in_front_and_a_frame_per_record(spark):
    rng = random.Random(2)
    words = [f"word{k}" for k in range(200)]
    rows = [(i, f"http://h/{i}", "<html><body class='main'><p>" + " ".join(rng.choices(words, k=60)) + "</p></body></html>") for i in range(400)]
    folder = scratch(spark, "test-warc")
    manifest = W.write_archives(pages(spark, rows, 2), folder, file_bytes=30_000).collect()
    assert len(manifest) > 2 and sum(m.n_records for m in manifest) == 400
    plain = 0
    for m in manifest:
        data = open(m.path.removeprefix("file://").removeprefix("file:"), "rb").read()
        assert int.from_bytes(data[:4], "little") == W.SKIPPABLE_MAGIC
        size = int.from_bytes(data[4:8], "little")
        assert zstandard.ZstdCompressionDict(data[8 : 8 + size]).dict_id() or size == 0
        records = list(W.read_file(m.path, chunk=700))
        assert len(records) == m.n_records and all(r.startswith(b"WARC/1.1\r\n") for r in records)
        plain += sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
        with pytest.raises((ValueError, zstandard.ZstdError)):
            bad = m.path.removeprefix("file://").removeprefix("file:") + ".cut"
            open(bad, "wb").write(data[:-5])
            list(W.read_file("file://" + bad))
    assert sum(m.file_bytes for m in manifest) < plain + 64 * 1024 * len(manifest)


@pytest.mark.parametrize("n,size", [(3, 4_000), (12, 200_000), (2, 3_000_000)])
def test_few_or_large_records_have_a_dictionary(tmp_path, n, size):
    rng = random.Random(4)
    words = [f"<b>{rng.randrange(10**6)}</b>" for _ in range(3000)]
    records = [" ".join(rng.choices(words, k=size // 12)).encode()[:size] for _ in range(n)]
    writer = W.Writer(f"file://{tmp_path}", W.FILE_BYTES)
    rows = [row for row in [*map(writer.add, records), writer.close()] if row]
    assert [list(W.read_file(row["path"])) for row in rows] == [records]
    data = open(rows[0]["path"].removeprefix("file://"), "rb").read()
    length = int.from_bytes(data[4:8], "little")
    assert length and zstandard.ZstdCompressionDict(data[8 : 8 + length]).dict_id()


def test_a_third_of_all_pages_are_equal(spark):
    rows = [(i, "u", "same" if i % 3 == 0 else f"page {i}") for i in range(300)]
    got = W.warc_round_trip(pages(spark, rows, 6))
    counts = {r.record_type: r["count"] for r in got.groupBy("record_type").count().collect()}
    assert counts == {"response": 201, "revisit": 99}
    assert got.where(F.col("record_type") == "revisit").select("refers_to").distinct().collect() == [(297,)]


def test_empty_table(spark):
    assert W.warc_round_trip(pages(spark, ROWS).limit(0)).collect() == []
