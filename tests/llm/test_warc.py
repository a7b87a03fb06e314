import base64
import hashlib
import io
import uuid

from adlens.llm import warc as A
from adlens.llm.common import shared_folder

PAGES = [(3, "http://a/1", "<p>same</p>"), (1, "http://a/2", "<p>same</p>"), (2, None, "<p>é😀\r\n\r\nWARC/1.1</p>"),
         (4, "http://a/\r\nX: y", None), (5, "u", ""), (6, "u", "x" * 300_000), (7, "u", "<p>same</p>"), (7, "u", "<p>same</p>"),
         (None, "u", "<p>same</p>"), (8, "u", "ab"), (9, "u", "ab")]


def brute(pages, min_bytes):
    raws = [(p, (h or "").encode()) for p, _, h in pages]
    out = []
    for p, raw in raws:
        same = [q for q, other in raws if other == raw and q is not None]
        first = min(same) if same and len(raw) >= min_bytes else p
        out.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), first))
    return out


def test_revisits_equal_brute_force(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    for min_bytes in (0, 3):
        got = A.archive_pages(pages, min_bytes).collect()
        assert len(got) == len(PAGES)
        for p, size, digest, first in brute(PAGES, min_bytes):
            rows = [r for r in got if r["page_id"] == p]
            assert all((r["payload_bytes"], r["payload_digest"]) == (size, digest) for r in rows)
            if p != first:
                assert all((r["record_type"], r["refers_to"]) == ("revisit", first) for r in rows)
        twice = sorted(r["record_type"] for r in got if r["page_id"] == 7)
        assert twice == ["revisit", "revisit"]
        assert sum(r["record_type"] == "response" for r in got) == (5 if min_bytes == 0 else 7)


def test_archives_hold_whole_payloads_and_fresh_headers(spark):
    base = f"{shared_folder(spark)}/warc-test-{uuid.uuid4().hex}"
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    A.write_archive(pages, f"{base}/raw")
    A.deduplicated(spark, f"{base}/raw", f"{base}/new")
    read = lambda f: [x for r in A._files(spark, f).collect() for x in A._parsed_file(bytes(r["content"]))]
    raw, new = read(f"{base}/raw"), read(f"{base}/new")
    assert sorted(b for _, b in raw) == sorted((h or "").encode() for _, _, h in PAGES)
    assert {h["WARC-Record-ID"] for h, _ in raw}.isdisjoint(h["WARC-Record-ID"] for h, _ in new)
    assert all(h["Content-Length"] == str(len(b)) for h, b in new)
    ids = {h["WARC-Record-ID"] for h, _ in new if h["WARC-Type"] == "response"}
    for h, b in new:
        if h["WARC-Type"] == "revisit":
            assert b == b"" and h["WARC-Refers-To"] in ids and h["WARC-Profile"] == A.REVISIT_PROFILE


def test_small_files_are_cut(spark, monkeypatch):
    monkeypatch.setattr(A, "FILE_RECORDS", 2)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    assert A.archive_pages(pages).count() == len(PAGES)


def test_parse_is_by_length():
    text = A.warc_record("response", "r", "u", 1, "D", 8, "a\r\n\r\nb\r\n") + A.RECORD_END
    text += A.warc_record("revisit", "s", "u", None, "D", 8, "", "r") + A.RECORD_END
    (h1, b1), (h2, b2) = A.parsed_records(io.BytesIO(text.encode()))
    assert b1 == b"a\r\n\r\nb\r\n" and h1["X-Page-ID"] == "1" and b2 == b"" and "X-Page-ID" not in h2


def test_empty_and_extra_columns(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as row", "'x' as file", "'y' as value")
    assert A.archive_pages(pages).count() == len(PAGES)
    assert A.archive_pages(pages.limit(0)).count() == 0


def _lines(kind, record_id, block, **headers):
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{record_id}>", "WARC-Date": "2020-02-02T00:00:00Z", **headers, "Content-Length": len(block)}
    return b"WARC/1.0\r\n" + "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def _folder(spark, **files):
    """A folder of archives of another maker, written byte by byte."""
    import os
    from adlens.session import checkpoint_dir
    base = f"{checkpoint_dir(spark)}/warc-foreign-{uuid.uuid4().hex}".removeprefix("file:")
    os.makedirs(f"{base}/raw")
    for name, content in files.items():
        with open(f"{base}/raw/{name.replace('__', '.')}", "wb") as f:
            f.write(content)
    return base


def _all(spark, folder):
    """{record id: (headers, block)} of an archive."""
    return {h["WARC-Record-ID"]: (h, b) for r in A._files(spark, folder).collect() for h, b in A._parsed_file(bytes(r["content"]))}


def _urn(old):
    return f"<urn:uuid:{A.fresh_id(old)}>"


def test_revisits_of_the_input_keep_their_payload(spark):
    """A revisit with a smaller page id than its response, in an archive of another maker."""
    digest = A.payload_digest(b"aaa")
    base = _folder(spark, a__warc=_lines("response", "r9", b"aaa", X_Page_ID=9)
                   + _lines("revisit", "r1", b"", X_Page_ID=1, WARC_Payload_Digest=f"sha1:{digest}", WARC_Refers_To="<urn:uuid:r9>"))
    A.deduplicated(spark, f"{base}/raw", f"{base}/new")
    got = sorted(tuple(r) for r in A.resolved(spark, f"{base}/new").collect())
    assert got == [(1, 3, digest, "revisit", 9), (9, 3, digest, "response", None)]
    assert sorted(b for _, b in _all(spark, f"{base}/new").values()) == [b"", b"aaa"]


def test_merged_archives_and_chains(spark):
    """Two archives with the same payload, revisits of both, one by digest only, one of a revisit, one without its original."""
    import gzip
    d = A.payload_digest(b"same")
    sha = f"sha1:{d}"
    one = _lines("response", "a5", b"same", X_Page_ID=5) + _lines("revisit", "a2", b"", X_Page_ID=2, WARC_Refers_To="<urn:uuid:a5>")
    two = (_lines("response", "b4", b"same", X_Page_ID=4) + _lines("revisit", "b7", b"", X_Page_ID=7, WARC_Payload_Digest=sha, WARC_Refers_To="<urn:uuid:b4>")
           + _lines("revisit", "b8", b"", X_Page_ID=8, WARC_Payload_Digest=sha)
           + _lines("revisit", "b9", b"", X_Page_ID=9, WARC_Payload_Digest=sha, WARC_Refers_To="<urn:uuid:b7>")
           + _lines("revisit", "lost", b"", X_Page_ID=3, WARC_Payload_Digest="sha1:" + A.payload_digest(b"gone"), WARC_Refers_To="<urn:uuid:elsewhere>"))
    base = _folder(spark, one__warc__gz=b"".join(gzip.compress(x) for x in (one,)), two__warc=two)
    A.deduplicated(spark, f"{base}/raw", f"{base}/new")
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_digest"]) for r in A.resolved(spark, f"{base}/new").collect()}
    assert got == {4: ("response", None, d), 5: ("revisit", 4, d), 2: ("revisit", 4, d), 7: ("revisit", 4, d), 8: ("revisit", 4, d),
                   9: ("revisit", 4, d), 3: ("revisit", None, A.payload_digest(b"gone"))}
    assert _all(spark, f"{base}/new")[_urn("lost")][0]["WARC-Refers-To"] == _urn("elsewhere")


def test_deduplicating_twice_gives_equal_records(spark):
    base = f"{shared_folder(spark)}/warc-test-{uuid.uuid4().hex}"
    A.write_archive(spark.createDataFrame(PAGES, "page_id long, url string, html string"), f"{base}/raw")
    A.deduplicated(spark, f"{base}/raw", f"{base}/one")
    A.deduplicated(spark, f"{base}/one", f"{base}/two")
    rows = lambda f: sorted(map(repr, A.resolved(spark, f"{base}/{f}").collect()))
    assert rows("one") == rows("two") and len(rows("one")) == len(PAGES)
    texts = lambda f: sorted((h["WARC-Type"], h.get("X-Page-ID", ""), h["X-Payload-Length"], h["WARC-Target-URI"], h["WARC-Date"], b)
                             for h, b in _all(spark, f"{base}/{f}").values())
    assert texts("one") == texts("two")


def test_other_records_and_http_messages(spark):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n"
    png = bytes(range(256)) * 40                              # not a text
    kind = {"Content_Type": "application/http; msgtype=response"}
    content = (_lines("warcinfo", "w", b"software: x\r\n", WARC_Filename="a.warc")
               + _lines("request", "q", b"GET / HTTP/1.1\r\n\r\n", WARC_Concurrent_To="<urn:uuid:p1>")
               + _lines("response", "p1", http + png, X_Page_ID=1, WARC_IP_Address="1.2.3.4", WARC_Warcinfo_ID="<urn:uuid:w>", **kind)
               + _lines("response", "p2", http.replace(b"200", b"203") + png, X_Page_ID=2, **kind)
               + b"\r\n" + _lines("metadata", "m", b"", WARC_Refers_To="<urn:uuid:p2>") + _lines("response", "p3", b"no http", X_Page_ID=3, **kind))
    base = _folder(spark, a__warc=content)
    A.deduplicated(spark, f"{base}/raw", f"{base}/new")
    new = _all(spark, f"{base}/new")
    assert len(new) == 6
    head, block = new[_urn("p1")]
    assert (head["WARC-Type"], block, head["WARC-IP-Address"], head["WARC-Warcinfo-ID"]) == ("response", http + png, "1.2.3.4", _urn("w"))
    assert head["WARC-Payload-Digest"] == "sha1:" + A.payload_digest(png) and head["WARC-Date"] == "2020-02-02T00:00:00Z"
    head, block = new[_urn("p2")]
    assert (head["WARC-Type"], head["WARC-Refers-To"], block) == ("revisit", _urn("p1"), http.replace(b"200", b"203"))
    assert new[_urn("w")][1] == b"software: x\r\n" and new[_urn("w")][0]["WARC-Filename"] == "a.warc"
    assert new[_urn("q")][0]["WARC-Concurrent-To"] == _urn("p1") and new[_urn("m")][0]["WARC-Refers-To"] == _urn("p2")
    assert {r["page_id"]: r["payload_bytes"] for r in A.resolved(spark, f"{base}/new").collect()} == {1: len(png), 2: len(png), 3: 0}
    A.deduplicated(spark, f"{base}/new", f"{base}/again")
    assert sorted(map(repr, A.resolved(spark, f"{base}/again").collect())) == sorted(map(repr, A.resolved(spark, f"{base}/new").collect()))
    assert sorted(b for _, b in _all(spark, f"{base}/again").values()) == sorted(b for _, b in new.values())


def test_a_copied_archive_loses_nothing(spark):
    one = _lines("response", "a", b"x", X_Page_ID=1) + _lines("response", "b", b"x", X_Page_ID=2)
    base = _folder(spark, a__warc=one, b__warc=one)
    A.deduplicated(spark, f"{base}/raw", f"{base}/new")
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in A.resolved(spark, f"{base}/new").collect())
    assert got == [(1, "response", None)] * 2 + [(2, "revisit", 1)] * 2


def test_one_gzip_member_for_each_record_and_parts_of_files(spark):
    import gzip
    base = f"{shared_folder(spark)}/warc-test-{uuid.uuid4().hex}"
    rows = [(i, "u", f"<p>{i}</p>" * 50 + "\r\n\r\nWARC/1.1\r\n" + chr(31) + "é") for i in range(3000)]
    A.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"{base}/raw")
    content = b"".join(bytes(r["content"]) for r in A._files(spark, f"{base}/raw").collect())
    members = content.split(A.BETWEEN)
    assert members[-1] == b"" and len(members) == 3001
    assert all(len(list(A._parsed_file(m))) == 1 for m in members[:5]) and gzip.decompress(A.BETWEEN) == b""
    assert len(list(A._parsed_file(content))) == 3000         # any reader of gzip sees one archive
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    read = A.records(own, f"{base}/raw")
    assert read.rdd.getNumPartitions() > 3 and read.count() == 3000


def test_cut_records_are_errors(spark):
    import pytest
    base = _folder(spark, a__warc=_lines("response", "a", b"x" * 100)[:-60])
    with pytest.raises(Exception, match="cut short"):
        A.read_headers(spark, f"{base}/raw").collect()
