from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest

import jsonflow.llm.queries as q
from jsonflow.llm import warc
from tests.llm.conftest import SF


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_query_round_trip(llm, tables):
    pages = {p: (html or "").encode() for p, _, html in tables("pages")}
    rows = q.QUERIES["op3_warc"](llm, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r["payload_bytes"], r["payload_digest"]) == (len(pages[r["page_id"]]), digest(pages[r["page_id"]]))


PAGES = [
    (1, "http://a/ b\r\nX: y", "same"),
    (2, None, "same"),
    (3, "http://c/", None),
    (4, "http://d/", ""),
    (5, "http://e/é", "é" * 200_000),
    (0, "http://f/", "other"),
    (9, "http://g/", "same"),
    (9, "http://g/", "same"),
    (None, "http://h/", "same"),
]


def test_revisits_nulls_and_repeats(llm):
    pages = llm.createDataFrame([(*p, 1, "x") for p in PAGES], "page_id long, url string, html string, digest int, first string")
    archives = warc.write_archives(pages.repartition(3))
    rows = warc.read_archives(archives, with_payload=True)
    rows = rows.withColumn("page", warc.page_of("record_id")).withColumn("first", warc.page_of("refers_to")).collect()
    got = sorted(((r["page"], r["record_type"], r["first"], r["payload_bytes"]) for r in rows), key=str)
    want = [
        (0, "response", None, 5), (1, "response", None, 4), (2, "revisit", 1, 4), (3, "response", None, 0), (4, "revisit", 3, 0),
        (5, "response", None, 400_000), (9, "revisit", 1, 4), (9, "revisit", 1, 4), (None, "response", None, 4),
    ]
    assert got == sorted(want, key=str)
    assert {bytes(r["payload"]) for r in rows if r["page"] == 5} == {("é" * 200_000).encode()}
    assert all(r["payload_digest"] == digest(b"same") for r in rows if r["payload_bytes"] == 4)
    assert sum(a["records"] for a in archives.collect()) == len(PAGES)


def test_small_payloads_are_never_revisits(llm):
    pages = llm.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = warc.read_archives(warc.write_archives(pages, least=5)).collect()
    assert {r["record_type"] for r in rows} == {"response"}


def test_empty_table(llm):
    pages = llm.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(pages)).count() == 0


def archive(*payloads):
    return b"".join(warc.record(i, f"http://x/{i}", p, None) for i, p in enumerate(payloads))


def test_every_record_is_a_gzip_member():
    data = archive(b"one", b"two" * 50_000)
    assert gzip.decompress(data).count(b"WARC/1.1") == 2
    read = list(warc.records(io.BytesIO(data), with_payload=True))
    assert [r["payload"] for r in read] == [b"one", b"two" * 50_000]


class Drip(io.BytesIO):
    """Gives a byte or two at a time."""

    def read(self, n=-1):
        return super().read(min(n, 2) if n > 0 else n)


def test_reading_in_small_parts():
    data = archive(b"first", b"", b"third\r\n\r\nwith an empty line")
    assert [r["payload"] for r in warc.records(Drip(data), with_payload=True)] == [b"first", b"", b"third\r\n\r\nwith an empty line"]


@pytest.mark.parametrize("harm", ["cut", "digest", "length", "other"])
def test_damage_is_told(harm):
    data = archive(b"payload")
    plain = gzip.decompress(data)
    if harm == "cut":
        data = data[:-20]
    elif harm == "digest":
        data = gzip.compress(plain.replace(b"payload\r\n", b"paiload\r\n"))
    elif harm == "length":
        data = gzip.compress(plain + b"more")
    else:
        data = gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n")
    with pytest.raises(warc.Damaged):
        list(warc.records(io.BytesIO(data)))
