import hashlib
import io

import pytest
import zstandard

from lexisift.llm import warc
from lexisift.llm.common import fresh_path

PAGES = [
    (1, "http://a/\r\nX: y", "<p>" + "é" * 60), (5, None, "<p>" + "é" * 60), (3, "http://b", "<p>" + "é" * 60), (4, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"),
    (9, "u", "long\r\n\r\nWARC/1.1\r\n" * 20000), (9, "u", "long\r\n\r\nWARC/1.1\r\n" * 20000), (None, "u", "z" * 200), (None, "u", "z" * 200), (None, "u", "y" * 200), (11, "u", "y" * 200),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS digest")
    folder = fresh_path(spark, "warc")
    got = warc.read_archives(warc.write_archives(warc.with_revisits(pages), folder), folder).collect()
    assert len(got) == len(PAGES)
    sizes = sorted(len((h or "").encode()) for _, _, h in PAGES)
    assert sorted(r["payload_bytes"] for r in got) == sizes
    assert {r["payload_digest"] for r in got} == {hashlib.sha256((h or "").encode()).hexdigest() for _, _, h in PAGES}
    by_id = {r["page_id"]: r for r in got if r["page_id"] is not None}
    assert (by_id[1]["record_type"], by_id[3]["refers_to"], by_id[5]["refers_to"], by_id[3]["payload"]) == ("response", 1, 1, None)
    assert by_id[1]["target_uri"] == "http://a/%0D%0AX: y" and by_id[7]["record_type"] == by_id[8]["record_type"] == by_id[9]["record_type"] == "response"
    assert sorted(str(r["refers_to"]) for r in got if r["page_id"] is None) == ["11", "None", "None"]


def test_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.op2_warc(spark, str(tmp_path)).count() == 0


def test_dictionary_leads_and_records_stand_alone():
    out = io.BytesIO()
    out.close = lambda: None
    writer = warc.ArchiveWriter(out)
    records = [warc.make_record(i, f"http://site/{i}", (f"<html><body><p>page {i} of the same site</p>" * 5).encode(), "d", None) for i in range(500)]
    for r in records:
        writer.add(r)
    writer.close()
    data = out.getvalue()
    magic, size = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
    assert magic == warc.DICTIONARY_MAGIC
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])).decompressobj()
    assert reader.decompress(data[8 + size :]) == records[0]  # the first frame is the first record alone
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(data) - size - 8 < plain / 2
    assert [b for _, b in warc.read_records(io.BytesIO(data))] == [r.split(b"\r\n\r\n", 1)[1][:-4] for r in records]


def test_broken_archive_raises():
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(zstandard.ZstdCompressor().compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))))


def test_each_archive_is_a_task(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(4)
    folder = fresh_path(spark, "warc")
    files = warc.write_archives(warc.with_revisits(pages).repartition(4), folder)
    assert files.count() > 1 and warc.read_archives(files, folder).rdd.getNumPartitions() == files.count()
