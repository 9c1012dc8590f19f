import gzip
import hashlib
from collections import Counter

import pytest

from opsledger.llm import web_archives as wa
from opsledger.session import run_folder


def rows_of(spark, pages, **options):
    work = run_folder(spark, "archives_test")
    wa.write_arc(pages, f"{work}/arc", **options)
    wa.convert_arc(spark, f"{work}/arc", f"{work}/warc")
    return work, wa.read_warc(spark, f"{work}/warc", payloads=True)


def brute(rows):
    """(page, bytes, digest, type, page referred to) by the rule of equal payloads, from the rows alone."""
    groups = {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = Counter()
    for payload, pages in groups.items():
        pages.sort(key=lambda p: -(1 << 63) if p is None else p)
        for i, page in enumerate(pages):
            last = i == len(pages) - 1 or len(payload) < 1000
            out[page, len(payload), hashlib.sha1(payload).hexdigest(), "response" if last else "revisit", None if last else pages[-1]] += 1
    return out


ODD = [(1, "http://a/x y\n", "p" * 1500), (2, None, "p" * 1500), (9, "http://a", "p" * 1500), (4, "", None), (5, "u", ""), (6, "u", "s" * 999),
       (7, "u", "s" * 999), (None, "u", "n" * 1000), (None, "u", "n" * 1000), (8, "u", "é" * 500), (10, "u", "é" * 500), (11, "u", "q" * 2000),
       (11, "u", "q" * 2000), (12, "http://ü/日本", "WARC/1.0\r\n\r\nHTTP/1.1 200 OK\r\n\r\nfiledesc: x\n1 0 y\n" * 60), (13, "dns:a", "\r\n\r\n\n\n"),
       (14, "u", "x" * 3_000_000)]


@pytest.mark.parametrize("archive_bytes", [1, 3000, 1 << 25])
def test_odd_pages(spark, archive_bytes):
    pages = spark.createDataFrame(ODD, "page_id bigint, url string, html string").selectExpr("*", "1 as path", "2 as place", "3 as `odd.name`")
    work, found = rows_of(spark, pages.repartition(3), archive_bytes=archive_bytes)
    rows = found.collect()
    assert Counter(tuple(r)[:5] for r in rows) == brute(ODD)
    texts = {r.page_id: r.payload for r in rows if r.record_type == "response"}
    assert texts[12].decode() == ODD[13][2] and texts[4] == b"" and len({r.record_id for r in rows}) == len(rows)
    assert {r.target for r in rows if r.page_id in (1, 2)} == {"http://a/x%20y%0A", "urn:address:missing"}
    again = f"{work}/again"
    wa.convert_arc(spark, f"{work}/arc", again)
    assert Counter(tuple(r) for r in wa.read_warc(spark, again, payloads=True).collect()) == Counter(tuple(r) for r in rows)


def test_no_pages(spark):
    _, found = rows_of(spark, spark.createDataFrame([], "page_id bigint, url string, html string"))
    assert found.count() == 0


def test_files_are_valid_for_other_readers(spark):
    work, found = rows_of(spark, spark.createDataFrame(ODD, "page_id bigint, url string, html string"))
    count = found.count()
    files = [r.content for r in wa.read_files(spark, f"{work}/warc").collect()]
    whole = b"".join(map(gzip.decompress, files))
    assert whole.startswith(b"WARC/1.0\r\nWARC-Type: warcinfo\r\n") and whole.endswith(b"\r\n\r\n")
    assert sum(1 for f in files for _ in wa.warc_records(f)) == count + len(files)


def test_both_versions_are_parsed_by_their_own_lines():
    body = b"HTTP/1.0 404 Not Found\r\nServer: x\r\n\r\nline\n\nline"
    one = b"filedesc://a.arc 0.0.0.0 19970101120000 text/plain 24\n1 0 org\nURL IP x date y\n\n" \
        + b"http://a/b c 1.2.3.4 1997010112 text/html %d\n" % len(body) + body + b"\n"
    two = b"filedesc://b.arc 0.0.0.0 19970101120000 text/plain 200 - - 0 b.arc 12\n2 0 org\nURL\n\n" \
        + b"http://a 1.2.3.4 19970101120059 text/html 404 - - 80 b.arc %d\n" % len(body) + body
    for data, url, date in ((one, "http://a/b c", "1997-01-01T12:00:00Z"), (two, "http://a", "1997-01-01T12:00:59Z")):
        head, record = wa.arc_records(data)
        assert head.fields["URL"].startswith("filedesc://") and (record.fields["URL"], record.body) == (url, body)
        assert wa.warc_date(record.fields["Archive-date"]) == date
        info, made = wa.warc_records(wa._converted("p", gzip.compress(data), {}))
        assert info[0]["warc-type"] == "warcinfo" and made[0]["warc-type"] == "response" and made[1] == body
        assert made[0]["warc-ip-address"] == "1.2.3.4" and made[0]["content-length"] == str(len(body))


@pytest.mark.parametrize("data", [b"nothing\n", b"filedesc://a 0 1 text/plain 9\n3 0 org\n", b"filedesc://a 0 1 text/plain 99\n1 0 org\n",
                                  b"filedesc://a 0 1 text/plain 8\n1 0 org\nhttp://a b\n", gzip.compress(b"filedesc://a 0 1 t 8\n1 0 org\n")[:-4]])
def test_damaged_files_are_named(data):
    with pytest.raises(wa.DamagedArchive, match="here.arc"):
        list(wa._records_of("here.arc", data))


def test_records_that_are_not_responses():
    data = b"filedesc://a 0.0.0.0 1 text/plain 8\n1 0 org\n\ndns:a 1.1.1.1 2001 text/dns 3\nabc\n"
    fields, block = list(wa.warc_records(wa._converted("p", data, {})))[1]
    assert fields["warc-type"] == "resource" and block == b"abc" and fields["warc-date"] == "2001-01-01T00:00:00Z"
