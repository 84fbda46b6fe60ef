"""WARC archives: exact round trip, framing, damage, revisits."""

import gzip
import hashlib
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle_compare import connect, differences

from fareloom.llm import oracle, warc
from fareloom.llm.queries import op3_warc
from fareloom.sources.sinks import new_folder

SF_DIR = "/root/testdata/sf0.001"


def sha(data):
    return hashlib.sha256(data).hexdigest()


def record(page_id, payload, refers_to=None, url="http://a/b c"):
    return warc.write_record(page_id, url, payload, sha(payload), refers_to)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=6), st.integers(1, 40))
def test_round_trip_in_small_chunks(payloads, chunk):
    archive = b"".join(record(k, p) for k, p in enumerate(payloads))

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, chunk))

    pages = list(warc.read_pages(Slow(archive)))
    assert [(p["page_id"], p["payload"]) for p in pages] == list(enumerate(payloads))
    assert all(p["payload_digest"] == sha(p["payload"]) for p in pages)


def test_every_record_is_a_gzip_member_of_its_own():
    one, two = record(1, b"x" * 200), record(2, b"x" * 200, refers_to=1)
    assert gzip.decompress(one + two) == gzip.decompress(one) + gzip.decompress(two)
    first, second = warc.read_pages(io.BytesIO(one + two))
    assert (second["record_type"], second["refers_to"], second["payload"]) == ("revisit", 1, None)
    assert second["payload_bytes"] == 200 and second["payload_digest"] == first["payload_digest"]


def test_damage_is_found():
    good = record(1, b"payload" * 50)
    for bad in (good[:-9], good[:40] + b"\x00" + good[41:], b"plain", record(2, b"") + b"junk"):
        with pytest.raises(warc.WarcError):
            list(warc.read_pages(io.BytesIO(bad)))
    text = gzip.decompress(good)
    for broken in (
        text.replace(b"payloadpayload", b"payloadpayl0ad", 1),
        text[:-4],
        text + b"more",
        text.replace(b"WARC/1.0", b"HTTP/1.0"),
        text.split(b"\r\n\r\n")[0],
    ):
        with pytest.raises(warc.WarcError):
            list(warc.read_pages(io.BytesIO(gzip.compress(broken))))


def test_line_breaks_in_a_url_do_not_add_headers():
    (page,) = warc.read_pages(io.BytesIO(record(1, b"x", url="http://a/\r\nContent-Length: 9")))
    assert page["payload"] == b"x" and "\n" not in page["url"]


def test_revisits_nulls_ties_and_clashing_columns(spark):
    same, short = "s" * 100, "t" * 99
    rows = [
        (5, "u", same, "a"), (3, None, same, "b"), (3, "u", same, "c"), (None, "u", same, "d"),
        (1, "u", short, "e"), (2, "u", short, "f"), (7, "u", None, "g"), (8, "u", "", "h"), (9, "u", "é" * 60, "i"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    got = sorted(
        ((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_and_read(spark, df).collect()),
        key=str,
    )
    assert got == sorted(
        [
            (5, 100, "revisit", 3), (3, 100, "response", None), (3, 100, "response", None), (None, 100, "revisit", 3),
            (1, 99, "response", None), (2, 99, "response", None), (7, 0, "response", None), (8, 0, "response", None),
            (9, 120, "response", None),
        ],
        key=str,
    )
    assert warc.archive_and_read(spark, df.limit(0)).count() == 0


def test_archives_roll_over_and_hold_the_payloads(spark):
    df = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "repeat(string(id), 50) AS html")
    folder = new_folder(spark, "warc")
    archives = warc.write_archives(df.coalesce(1), folder, most_bytes=2000)
    assert archives.count() > 1 and archives.agg({"n_records": "sum"}).first()[0] == 40
    pages = warc.read_archives(spark, archives, folder).collect()
    assert {p.page_id: bytes(p.payload).decode() for p in pages} == {i: str(i) * 50 for i in range(40)}


def test_query_equals_its_sql(spark):
    assert differences(op3_warc(spark, SF_DIR), connect(SF_DIR), oracle.SQL["op3_warc"]) == []
