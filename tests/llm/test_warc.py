from __future__ import annotations

import base64
import hashlib

from tierstone.llm import warc

PAGE = (
    "<html><head><title>t</title><style>p{}</style></head><body><nav>Home</nav>"
    "<p>One &amp; <b>two</b>\n three<script>x<y</script><p>é\U0001f600</body></html>"
)


def test_record_round_trip():
    headers = [("WARC-Type", "response"), ("X-Twice", "a"), ("X-Twice", "b"), ("Long", "a\r\n folded")]
    data = warc.build(headers, b"\r\n\r\nblock\r\n")
    got, block, end = warc.parse(data)
    assert got == [*headers, ("Content-Length", "11")] and block == b"\r\n\r\nblock\r\n"
    assert end == len(data)


def test_digest():
    assert warc.digest(b"x") == "sha1:" + base64.b32encode(hashlib.sha1(b"x").digest()).decode()


def test_derivatives_are_linked_and_keep_the_source():
    source = warc.response_record("http://a.example/é", PAGE)
    head = dict(warc.parse(source)[0])
    made = dict(warc.derivatives(source))
    assert set(made) == {"metadata", "conversion"}
    for kind, record in made.items():
        own, block, end = warc.parse(record)
        fields = dict(own)
        assert end == len(record) and fields["WARC-Type"] == kind
        assert fields["WARC-Refers-To"] == head["WARC-Record-ID"]
        assert fields["WARC-Target-URI"] == "http://a.example/é"
        assert fields["WARC-Date"] == head["WARC-Date"]
        assert fields["WARC-Source-Payload-Digest"] == head["WARC-Payload-Digest"]
        assert fields["WARC-Block-Digest"] == warc.digest(block)
        assert int(fields["Content-Length"]) == len(block)
    meta = warc.parse(made["metadata"])[1].decode()
    for name, value in head.items():
        assert f"source-{name}: {value}\r\n" in meta
    assert "http-status: HTTP/1.1 200 OK\r\n" in meta and "http-Content-Type: text/html" in meta
    assert warc.parse(made["conversion"])[1].decode() == "Home\nOne & two three\né\U0001f600"
    assert warc.value_of(warc.parse(made["metadata"])[0], "WARC-Record-ID") != warc.value_of(
        warc.parse(made["conversion"])[0], "WARC-Record-ID"
    )


def test_other_records_and_blocks():
    request = warc.build([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:x>")], b"GET /")
    assert warc.derivatives(request) == []
    bare = warc.build([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], b"<p>bare</p>")
    made = dict(warc.derivatives(bare))
    assert warc.parse(made["conversion"])[1] == b"bare"
    http = b"HTTP/1.0 404 No\r\nContent-Type: text/plain; charset=latin-1\r\n\r\n<p>caf\xe9"
    made = dict(warc.derivatives(warc.build([("WARC-Type", "response")], http)))
    assert warc.parse(made["conversion"])[1].decode() == "<p>café"


def test_tables(spark):
    schema = "page_id long, url string, html string, record string, type int"
    rows = [(1, "http://a", PAGE, None, 1), (1, "http://a", PAGE, None, 1), (None, None, None, None, 1),
            (2, "http://b", "", None, 1), (3, "http://c", "<p>" + "long " * 200_000, None, 1)]
    pages = spark.createDataFrame(rows, schema)
    found = warc.derive(warc.responses(pages)).collect()
    assert len(found) == 10
    assert {r["refers_to"] for r in found if r["page_id"] == 1} == {
        dict(warc.parse(warc.response_record("http://a", PAGE))[0])["WARC-Record-ID"]
    }
    empty = next(r for r in found if r["page_id"] == 2 and r["type"] == "conversion")
    assert empty["content_length"] == 0
    assert warc.derive(warc.responses(spark.createDataFrame([], schema))).count() == 0


def test_files_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://{k}", f"<p>page {k}") for k in range(20)],
                                  "page_id long, url string, html string")
    derived = warc.derive(warc.responses(pages))
    for k, row in enumerate(warc.archived(derived, 500).collect()):
        (tmp_path / f"{k}.warc.gz").write_bytes(bytes(row["warc_gz"]))
    back = warc.read_archives(spark, f"file:{tmp_path}")
    expected = sorted(bytes(r["record"]) for r in derived.collect())
    assert sorted(bytes(r["record"]) for r in back.collect()) == expected


def test_line_breaks_in_urls_stay_in_their_header():
    urls = ["http://a/\r\n\r\nx", "http://a/\r\nContent-Length: 3", "http://a/\n\x00\tb", "http://a/\r\n\r\ny"]
    ids = set()
    for url in urls:
        source = warc.response_record(url, PAGE)
        head = dict(warc.parse(source)[0])
        made = dict(warc.derivatives(source))
        plain = dict(warc.derivatives(warc.response_record("http://a/", PAGE)))
        for kind in ("metadata", "conversion"):
            own, block, end = warc.parse(made[kind])
            fields = dict(own)
            assert end == len(made[kind]) and fields["WARC-Refers-To"] == head["WARC-Record-ID"]
            assert not set(fields["WARC-Target-URI"]) & set("\r\n\x00\t")
            assert kind == "metadata" or block == warc.parse(plain[kind])[1] != b""
            ids.add(fields["WARC-Record-ID"])
    assert len(ids) == 2 * len(urls)
    assert warc.escaped("http://a/é%0D") == "http://a/é%0D"
