"""Main text by roles and differencing; longest common subsequences; archives written and read back."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from kinlink.llm import html, warc

PAGE = "page_id long, url string, html string"


def brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_lines_match_brute_force():
    pick = random.Random(1)
    for _ in range(1500):
        a, b = ([pick.randrange(5) for _ in range(pick.randrange(13))] for _ in "ab")
        for most in (1 << 28, 4):
            found = html.shared(a, b, most)
            rest = iter(b)
            assert len(found) == brute_lcs(a, b) and found == sorted(set(found)) and all(a[i] in rest for i in found)


def text(page):
    return [t for t, role in html.lines(page) if role == html.KEPT]


def test_lines_of_a_page():
    page = """<html><head><title>T &amp; x</title><style>p{a:"</p>"}</style></head><body><nav><p>menu</p></nav><div class="top ad">buy</div>
    <article class="post"><h1>Head &lt;1&gt;</h1><p>one  two<br>three<p>A <b>bold</b> <a href="x>y">link</a> &eacute;&#233;&nbsp;z &am &bogus;</p><!-- <p>no</p> -->
    <script>if (a < b) document.write("<p>no</p>")</script><aside>side</aside><form><p>mail</p></form><p class="cookie-notice">accept</p><p>with <span class="advert">spot</span>end</p>
    <ul><li>i</li><li>j</ul><div id="comments"><p>first!</p></div></article><footer>(c)</footer></body></html>"""
    assert text(page) == ["Head <1>", "one two", "three", "A bold link éé z &am &bogus;", "with end", "i", "j"]
    assert text("<article>open <p>never closed <b>x") == ["open", "never closed x"]
    assert html.lines(None) == html.lines("") == html.lines("<!-- open") == html.lines("<p title='open") == []
    assert [t for t, _ in html.lines("a < b <3")] == ["a < b <3"]
    assert text("<article><p>" + "x " * 200_000 + "</p></article>") == [("x " * 200_000).strip()]


def test_layout_classes_keep_the_page():
    for wrap in ('<div class="page has-sidebar">', '<div id="wrap" class="no-sidebar">', '<div class="page sidebar">', '<div class="with-search"><section class="header-fixed">', '<my-app class="page sidebar">'):
        assert text(f'<body>{wrap}<div class="ad">buy</div><article><p>one</p><p>two and more</p></article></div></body>') == ["one", "two and more"], wrap
    assert html.lines('<div class="search"><p>all the text of it</p></div><p>end</p>') == [("all the text of it", html.OPEN), ("end", html.OPEN)]
    aside = '<div class="related"><article><p>teaser</p></article></div>'
    assert text(f"<article><p>own</p></article>{aside}") == ["own"]
    assert html.lines(f"<p>a text without an article</p>{aside}") == [("a text without an article", html.OPEN), ("teaser", html.GONE)]
    assert text('<article><p>own</p><ul class="comment-list"><li>first!</li></ul></article>') == ["own"]


def test_hostile_pages_take_linear_time():
    for part in ("<a ", '<a x="', "<b>", "</b>", "<!--", "<script>", "&#", "<div class='ad'>"):
        html.lines(part * 60_000)


SITE = "<body><p>Logo</p><p>Welcome to the site</p>{}<p>Write to us</p></body>"


def test_differencing_removes_what_neighbours_share(spark):
    rows = [(i, f"http://h.example/a/{i}", SITE.format(f"<p>story {i}</p><p>more of {i}</p><p>and {i}</p><p>last {i}</p>")) for i in range(6)]
    rows += [(10, "http://h.example/a/10", SITE.format("<p>alone</p>")), (11, "http://other.example/x", SITE.format("<p>only page of its host</p>"))]
    rows += [(12, "http://c.example/1", SITE.format("<article><p>Logo</p><p>own</p></article>")), (13, "http://c.example/2", SITE.format("<article><p>Logo</p><p>own</p></article>"))]
    rows += [(14, None, None), (14, None, ""), (15, "not a url", "<p>x</p>"), (None, "http://h.example/a/0", None)]
    out = html.main_text(spark.createDataFrame(rows, PAGE).withColumn("text", F.lit(1))).collect()
    assert len(out) == len(rows)
    got = {r.page_id: r.text for r in out}
    for i in range(6):
        assert got[i] == f"story {i}\nmore of {i}\nand {i}\nlast {i}"
    assert got[10] == "alone" and got[11] == "Logo\nWelcome to the site\nonly page of its host\nWrite to us"
    assert got[12] == got[13] == "Logo\nown" and got[14] == "" and got[15] == "x" and got[None] == ""
    assert html.main_text(spark.createDataFrame([], PAGE)).count() == 0


def test_pages_with_articles_take_part_in_differencing(spark):
    page = "<p>Logo</p><p>Welcome</p><article><p>By the desk</p>{}<p>Share this story</p></article>{}"
    rows = [(i, f"http://h.example/a/{i}", page.format(f"<p>story {i}</p><p>more of {i}</p><p>as they say</p>" if i < 2 else f"<p>story {i}</p><p>more of {i}</p>", f"<p>postscript {i}</p>" if i == 3 else "")) for i in range(6)]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, PAGE)).collect()}
    for i in range(6):  # what two of six pages have is text, what all have is not
        assert got[i] == f"story {i}\nmore of {i}" + ("\nas they say" if i < 2 else "") + ("\npostscript 3" if i == 3 else "")


def test_copies_prove_nothing(spark):
    story = SITE.format("".join(f"<p>line {i}</p>" for i in range(20)))
    rows = [(1, "http://h.example/a/1", story), (2, "http://h.example/a/1?page=2", story), (3, "http://h.example/z", SITE.format("<p>something else</p>"))]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, PAGE)).collect()}
    assert "line 7" in got[1] and "line 7" in got[2] and got[3] == "something else"


def captured(spark, path, rows, **options):
    warc.write_warc(spark.createDataFrame(rows, PAGE).withColumn("type", F.lit("x")), path, **options)
    return warc.assemble(warc.read_warc(spark, path)).collect()


def test_archive_round_trip(spark, tmp_path):
    big = "é\r\n\r\nWARC/1.0\r\n" * 200
    rows = [(1, "http://a/1", big), (7, "http://a/7", big), (3, "http://a/3", big), (4, "u\r\nrl", "small"), (5, None, "small"), (6, "http://a/6", None), (None, "http://a/n", ""), (8, "http://a/8", "x" * 999), (9, "http://a/9", "x" * 999), (2, "dup", "dup"), (2, "dup", "dup")]
    out = captured(spark, str(tmp_path / "w"), rows, records_per_file=4)
    assert len(out) == len(rows)
    assert len(list((tmp_path / "w").glob("part-*"))) > 3
    for r in out:
        page = r.metadata.fields.get("page-id")
        want = next(h or "" for i, _, h in rows if str(i) == str(page))
        assert r.response.digest == hashlib.sha1(want.encode()).hexdigest() and r.response.payload_bytes == len(want.encode())
        revisit = page in ("1", "3")
        assert r.response.type == ("revisit" if revisit else "response") and r.metadata.fields.get("refers-to-page-id") == ("7" if revisit else None)
        assert (r.response.payload is None) if revisit else (bytes(r.response.payload) == want.encode())
        assert r.request.uri == r.uri
    main = next(r for r in out if r.metadata.fields.get("page-id") == "7")
    assert {r.response.refers_to for r in out} == {None, main.capture_id}
    empty = str(tmp_path / "none")
    warc.write_warc(spark.createDataFrame([], PAGE), empty)
    assert warc.assemble(warc.read_warc(spark, empty)).count() == 0


def test_records_of_foreign_archives(spark, tmp_path):
    def record(kind, rid, extra, body):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\n{extra}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    http = "Content-Type: application/http; msgtype=response\r\n"
    parts = [record("warcinfo", "<i>", "", b"software: x"), record("response", "<r>", http, b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n\x00\xff"), record("request", "<q>", "WARC-Concurrent-To: <r>\r\n", b"GET /"), record("metadata", "<m>", "WARC-Concurrent-To: <gone>\r\n", b"a: b")]
    (tmp_path / "f.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    rows = warc.assemble(warc.read_warc(spark, str(tmp_path))).collect()
    assert [(r.capture_id, r.request.record_id, r.metadata, bytes(r.response.payload)) for r in rows] == [("<r>", "<q>", None, b"\x00\xff")]
    with pytest.raises(ValueError):
        list(warc.parse(parts[1][:-20]))
    with pytest.raises(ValueError):
        list(warc.parse(b"nothing of the kind\r\n"))


def test_every_page_is_compared(spark):
    """Each page's lines are told apart: kept, shared with its neighbour, or deleted for their role alone."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = html.decided(pages).collect()
    assert len(rows) == pages.count()
    assert all(r.n_kept + r.n_by_role <= r.n_lines <= r.n_kept + r.n_by_role + r.n_shared for r in rows)
    assert sum(r.n_shared > 0 for r in rows) > 20 and sum(r.n_shared for r in rows) > 50
    site = [(i, f"http://h.example/a/{i}", SITE.format(f"<p>story {i}</p><p>more of {i}</p><p>and {i}</p><p>last {i}</p>")) for i in range(4)]
    got = html.decided(spark.createDataFrame(site, PAGE)).collect()
    assert {(r.n_lines, r.n_shared, r.n_kept, r.n_by_role) for r in got} == {(7, 3, 4, 0)}


def test_clashing_names_and_repeated_pages(spark):
    rows = [(1, "http://h.example/1", "<article><p>one</p></article>")] * 2 + [(None, None, None)]
    df = spark.createDataFrame(rows, PAGE).withColumns({c: F.lit(c) for c in ("lines", "host", "_id", "stay", "_payload", "fields")})
    out = html.main_text(df)
    assert out.columns == ["page_id", "url", "text"] and sorted(r.text for r in out.collect()) == ["", "one", "one"]
    assert html.decided(df.limit(0)).count() == 0
