import gzip
import hashlib
import random

import pytest

from railgauge.llm import warc

HTML = "<html>" + "x" * 1000 + "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n</html>"
PAGES = [
    (1, "http://a.example/x", HTML),
    (2, "http://b.example/x?q=1", HTML),
    (3, None, HTML),
    (4, "http://c.example/\r\nWARC-Type: bad", "é" * 499),
    (5, "http://c.example/", "é" * 499),
    (6, "http://d.example/", None),
    (7, "", ""),
    (8, "no scheme", "\r\n\r\n"),
    (None, "http://e.example/", HTML),
    (None, None, "y" * 2000),
    (9, "http://same.example/", "z" * 1500),
    (9, "http://same.example/", "z" * 1500),
    (9, "http://same.example/a", "z" * 1500),
    (10, "http://long.example/", "l" * 3_000_000),
]


def plain(pages, least=1000):
    owner, out = {}, []
    key = lambda p, u: ((p is not None, p or 0), (u is not None, u or ""))
    for p, u, h in pages:
        if len((h or "").encode()) >= least:
            owner[h] = max(owner.get(h, key(None, None)), key(p, u))
    for p, u, h in pages:
        data = (h or "").encode()
        again = h in owner and owner[h] != key(p, u)
        refers = owner[h][0][1] if again and owner[h][0][0] else None
        out.append((p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", refers))
    return sorted(out, key=repr)


@pytest.fixture
def pages(spark):
    def build(rows):
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
        return df.selectExpr("*", "'q' as bytes", "'q' as digest", "'q' as owner", "'q' as payload")

    return build


def back(spark, path, with_payload=False):
    return warc.read_records(spark, path, with_payload).cache()


def test_round_trip(spark, pages, tmp_path):
    warc.write_archives(pages(PAGES), f"{tmp_path}/a", archive_bytes=200)
    found = back(spark, f"{tmp_path}/a", True)
    assert found.filter("not coalesce(intact, true)").count() == 0
    assert found.select("archive").distinct().count() == len(PAGES)
    rows = warc.page_captures(warc.assemble(found)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, rows.collect()), key=repr) == plain(PAGES)
    held = {bytes(r[0]).decode() for r in found.filter("record_type = 'response'").select("payload").collect()}
    assert held == {h or "" for _, _, h in PAGES}


def test_ids_link_the_three_records(spark, pages, tmp_path):
    warc.write_archives(pages(PAGES[:2]), f"{tmp_path}/a")
    found = back(spark, f"{tmp_path}/a")
    by = {(r["record_type"], r["target_uri"]): r for r in found.collect()}
    revisit, response = by["revisit", PAGES[0][1]], by["response", PAGES[1][1]]
    assert revisit["refers_to"] == response["record_id"] and revisit["headers"]["warc-profile"] == warc.IDENTICAL
    for kind in ("request", "metadata"):
        assert by[kind, PAGES[1][1]]["concurrent_to"] == [response["record_id"]]
    assert len({r["record_id"] for r in by.values()}) == 6
    nested = warc.assemble(found).filter("capture.record_type = 'response'").first()
    assert nested["request"]["http_head"].startswith("GET /x?q=1 HTTP/1.1\r\nHost: b.example")
    assert nested["metadata"]["fields"] == {"page-id": "2", "payload-bytes": str(len(HTML))} and nested["n_request"] == 1


def foreign(kind, record_id, *headers, block=b""):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", *headers, f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    """Plain and compressed as a whole, folded headers, several links, links from the capture's side, records on their own."""
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody"
    sha = "WARC-Payload-Digest: sha1:" + hashlib.sha1(b"body").hexdigest().upper()
    first = [
        foreign("warcinfo", "<w>", block=b"software: x"),
        foreign("response", "<r1>", "Content-Type: application/http;msgtype=response", "WARC-Target-URI: http://x/\r\n y", sha, block=http),
        foreign("request", "<q2>", "WARC-Concurrent-To: <r1>", "WARC-Concurrent-To: <r2>", block=b"GET"),
        foreign("request", "<q1>", "WARC-Concurrent-To: <r1>", block=b"GET"),
    ]
    second = [
        foreign("response", "<r2>", "WARC-Concurrent-To: <m1>", "WARC-Payload-Digest: sha1:" + "0" * 40, block=b"raw"),
        foreign("metadata", "<m1>", "Content-Type: application/warc-fields", block=b"a: 1\r\npage-id: 5\r\n"),
        foreign("metadata", "<m2>", "WARC-Concurrent-To: <nowhere>"),
        foreign("revisit", "<v>", "WARC-Refers-To: <r2>", sha),
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.warc").write_bytes(b"".join(first))
    (tmp_path / "in" / "two.warc.gz").write_bytes(gzip.compress(b"".join(second)))
    (tmp_path / "in" / "none.warc").write_bytes(b"")
    found = back(spark, f"{tmp_path}/in")
    rows = {r["capture"]["record_id"]: r for r in warc.assemble(found).collect()}
    assert set(rows) == {"<r1>", "<r2>", "<v>"}
    assert (rows["<r1>"]["request"]["record_id"], rows["<r1>"]["n_request"], rows["<r1>"]["n_metadata"]) == ("<q1>", 2, 0)
    assert (rows["<r2>"]["request"]["record_id"], rows["<r2>"]["metadata"]["fields"]) == ("<q2>", {"a": "1", "page-id": "5"})
    assert rows["<r1>"]["capture"]["intact"] and rows["<r2>"]["capture"]["intact"] is False and rows["<v>"]["capture"]["intact"] is None
    assert rows["<r1>"]["capture"]["target_uri"] == "http://x/ y" and rows["<r1>"]["capture"]["payload_bytes"] == 4
    shown = {r["payload_digest"]: r for r in warc.page_captures(warc.assemble(found)).collect()}
    assert shown[hashlib.sha1(b"raw").hexdigest()]["page_id"] == 5
    assert [r["refers_to"] for r in shown.values() if r["record_type"] == "revisit"] == [5]


@pytest.mark.parametrize("damage", [b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 9\r\n\r\nshort", b"no record\r\n", b"WARC/1.1\r\n\r\n"])
def test_damage_is_named(damage):
    with pytest.raises(ValueError, match="some.warc"):
        list(warc.records(damage, "some.warc"))


def test_random_payloads():
    rng = random.Random(2)
    parts = [b"\r\n", b"WARC/1.1\r\n", b"\x00", b"\x1f\x8b", b"a", b"Content-Length: 3\r\n\r\n"]
    blocks = [b"".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(300)]
    archive = b"".join(warc.record("resource", f"<{i}>", {}, b) for i, b in enumerate(blocks)) + b"\0"
    assert [b for _, b in warc.records(archive, "x")] == blocks


def test_no_pages(spark, pages, tmp_path):
    warc.write_archives(pages([]), f"{tmp_path}/a")
    assert warc.page_captures(warc.assemble(back(spark, f"{tmp_path}/a"))).collect() == []
