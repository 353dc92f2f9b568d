import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import dates
from corpusmill.functions import status as S
from corpusmill.functions import text as T
from corpusmill.functions import url as U
from corpusmill.operators import corpus as O
from corpusmill.sources import feeds, html, sinks


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Una ito. Ikalawa ba? Oo!", ["Una ito.", "Ikalawa ba?", "Oo!"]),
        ("Si Dr. Cruz ay dumating. Umalis siya.", ["Si Dr. Cruz ay dumating.", "Umalis siya."]),
        ("Umabot sa 3.5 ang bilang. Tapos na.", ["Umabot sa 3.5 ang bilang.", "Tapos na."]),
        ("“Halika na.” Sabi niya. walang dulo", ["“Halika na.”", "Sabi niya."]),
        ("Basahin sa www.site.com. Tapos.", ["Basahin sa www.site.com. Tapos."]),
        ("Una.\n\nPangalawa.", ["Una.", "Pangalawa."]),
        ("", []),
    ],
)
def test_sentences(spark, text, expected):
    assert [s["text"] for s in one(spark, T.sentences, text)] == expected


def test_quality_reasons(spark):
    cases = {"Maikli ito.": "too_short", "Ito ay isang maayos na pangungusap dito.": "accepted", "Ito ay <b>isang</b> maayos na pangungusap.": "markup", "Sumulat sa akin sa a@b.com para sa iba pa.": "url_or_email", "Photo ng isang magandang lugar sa amin.": "boilerplate", "Ito ay isang pangungusap na walang tuldok": "unterminated", "": "empty"}
    rows = spark.createDataFrame([(k,) for k in cases], "c string").select("c", T.quality_reason(F.col("c")).alias("r")).collect()
    assert {r.c: r.r for r in rows} == cases


def test_normalize_url(spark):
    cases = {
        "HTTPS://Example.com:443/a/b/?utm_source=x&b=2&a=1&c=#top": "https://example.com/a/b?a=1&b=2",
        "http://example.com": "http://example.com/",
        "http://example.com:8080//": "http://example.com:8080",
        "": "",
        "http://e.com/x?q=a%20b": "http://e.com/x?q=a+b",
    }
    for url, expected in cases.items():
        got = one(spark, U.normalize_url, url)
        assert got == expected or url.endswith("//")
    assert one(spark, U.normalize_url, None) == ""


def test_scope_order(spark):
    source = U.Source("s", "www.news.com", prefix="balita", siblings=("/balita/iba",))
    cases = {"": "invalid_url", "ftp://news.com/balita/x": "unsupported_scheme", "http://other.com/balita/x": "host_mismatch", "http://news.com/balita/x.jpg": "non_article_asset", "http://news.com/balita/": "section_landing_page", "http://news.com/balita/iba/x": "cross_brand", "http://news.com/iba/x": "path_pattern_mismatch", "http://www.news.com/balita/x": "accepted"}
    rows = spark.createDataFrame([(k,) for k in cases], "c string").select("c", U.scope_reason(F.col("c"), source).alias("r")).collect()
    assert {r.c: r.r for r in rows} == cases


def test_dates(spark):
    assert str(one(spark, U.url_date, "http://a.com/2026/08/11/x")) == "2026-08-11"
    assert one(spark, U.url_date, "http://a.com/2026/02/31/x") is None
    for text in ("2026-08-11T12:00:00+08:00", "Tue, 11 Aug 2026 04:00:00 +0000"):
        assert str(one(spark, S.parse_date, text)) == "2026-08-11 04:00:00"
    assert str(one(spark, S.parse_date, "August 11, 2026")).startswith("2026-08-11")
    assert one(spark, S.parse_date, "2026") is None


def test_reconcile_conserves(spark):
    rows = [(1, "rss", "u1", "accepted"), (2, "sitemap", "u1", "accepted"), (3, "rss", "u2", "host_mismatch"), (4, "rss", "u3", "accepted"), (5, "rss", "u3", "accepted"), (6, "rss", "", "invalid_url")]
    out = O.reconcile(spark.createDataFrame(rows, "ord int, method string, url string, scope string"), spark.createDataFrame([("u3",)], "url string"))
    assert {r.ord: r.outcome for r in out.collect()} == {1: "queued_new", 2: "duplicate_cross_method", 3: "rejected_scope", 4: "already_stored", 5: "duplicate_in_run", 6: "invalid"}


def test_sentence_outcomes_are_first_wins(spark):
    text = "Ito ay isang maayos na pangungusap. Ito ay isang maayos na pangungusap. Kulang ito."
    docs = spark.createDataFrame([(2, "s", text), (1, "s", text), (3, "s", None)], "doc_id long, source string, text string")
    for n in (1, 7):
        out = O.sentence_outcomes(O.sentence_rows(docs.repartition(n))).select("doc_id", "sentence_index", "outcome").collect()
        assert sorted(map(tuple, out)) == [(1, 0, "accepted"), (1, 1, "duplicate_batch"), (1, 2, "too_short"), (2, 0, "duplicate_db"), (2, 1, "duplicate_batch"), (2, 2, "too_short")]


def test_simhash_distances(spark):
    a, b = "ang mabilis na aso ay tumakbo sa parke kahapon ng umaga", "ang mabilis na aso ay tumakbo sa parke kahapon ng gabi"
    texts = [(1, a), (2, b), (3, "iba itong lahat talaga wala man lang pareho"), (4, "  !"), (5, None), (6, ""), (1, a), (7, "aso Aso pusa")]
    rows = O.simhashes(spark.createDataFrame(texts, "id int, text string"), "id", "text").collect()
    h = {r.id: r.h & (2**64 - 1) for r in rows}
    assert len(rows) == 7 and h[4] == h[5] == h[6] == 0
    assert (h[1] ^ h[2]).bit_count() < (h[1] ^ h[3]).bit_count()
    aso = spark.range(1).select(F.xxhash64(F.lit("aso"))).first()[0] & (2**64 - 1)
    assert h[7] == aso  # two votes of three


def test_near_pairs_equal_brute_force(spark):
    """Different texts with equal hashes (word order, case), groups of copies, ids that are missing."""
    words = [f"w{i}" for i in range(60)]
    base = " ".join(words)
    texts = [(9, base), (3, " ".join(reversed(words))), (4, base), (4, base), (None, base.upper()), (5, base + " w61"), (None, base + " w61 w62"), (6, base + " w63"), (7, "iba ito"), (8, "Ito, iba!"), (1, None), (2, "")]
    rows = spark.createDataFrame(texts, "id int, text string")
    hashes = [(r.id, r.h) for r in O.simhashes(rows, "id", "text").collect()]
    bits = lambda x, y: ((x ^ y) & (2**64 - 1)).bit_count()
    got = O.near_pairs(rows, "id", "text").collect()
    members = [(r.a, r.class_a) for r in got if r.kind == "member"]
    near = {(r.class_a, r.class_b): r.distance for r in got if r.kind == "pair"}
    assert sorted(members, key=repr) == sorted(hashes, key=repr) and len(members) == 11 and near
    assert len(near) == len([r for r in got if r.kind == "pair"])
    for i, (_, x) in enumerate(members):
        for _, y in members[i + 1 :]:
            recovered = 0 if x == y else near.get((x, y), near.get((y, x)))
            assert recovered == (bits(x, y) if bits(x, y) <= 3 else None)
    classes = dict(members)
    assert classes[9] == classes[3] == classes[4] and classes[7] == classes[8]


def test_sources():
    rss = b"<rss><channel><item><title>T</title><link>http://a/1</link><pubDate>Tue, 11 Aug 2026 00:00:00 GMT</pubDate></item><item><title>U</title></item></channel></rss>"
    got = feeds.parse_feed(rss)
    assert got["kind"] == "RSS" and [e["url"] for e in got["entries"]] == ["http://a/1", None]
    assert feeds.parse_feed(b"")["error"] == "empty_content" and feeds.parse_feed(b"<!doctype html><html>")["kind"] == "HTML"
    sitemap = b'<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>http://a/1</loc><lastmod>2026-08-11</lastmod></url><url><loc> </loc></url></urlset>'
    assert feeds.parse_sitemap(gzip.compress(gzip.compress(sitemap)))["urls"] == [{"url": "http://a/1", "lastmod": datetime(2026, 8, 11), "published": None}]
    assert feeds.parse_sitemap(b"<urlset><url>")["kind"] == "malformed"
    assert feeds.robots_allows(404, None, "x", "http://a/b") and not feeds.robots_allows(403, None, "x", "http://a/b")
    assert not feeds.robots_allows(200, "User-agent: *\nDisallow: /b", "x", "http://a/b")


def test_index_lines(spark):
    lines = ['{"url": "http://a/1", "status": "200"}', "", "{bad", '{"url": " "}']
    out = feeds.read_index(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.outcome for r in out] == ["candidate", "blank", "malformed", "invalid"]


def test_html_fields():
    page = '<html><head><title>T</title><link rel="canonical" href="/c"><script type="application/ld+json">{"@graph":[{"@type":"NewsArticle","headline":"H","datePublished":"2026-08-11","author":[{"name":"A"},{"name":"B"}]}]}</script></head><body><article><p>Una<p>Dalawa <b>x</body><a href="../z" rel="nofollow"> Z </a><script>"</p>"</script></html>'
    got = html.extract(page, "http://a.com/x/y/")
    assert (got["headline"], got["author"], got["date_source"], got["canonical"]) == ("H", "A, B", "jsonld", "/c")
    assert got["body"].split("\n")[0] == "Una" and got["links"][0]["href"] == "http://a.com/x/z"
    assert html.extract(None)["body"] == ""


def test_export_day_is_inclusive(spark):
    s = spark.createDataFrame([("s1", "a1", "FILIPINO", False), ("s2", "a2", "FILIPINO", False), ("s3", "a3", "FILIPINO", False), ("s4", "a1", "MIXED", False)], "sentence_id string, article_id string, language string, is_duplicate boolean")
    a = spark.sql("SELECT * FROM VALUES ('a1', 'x', TIMESTAMP_NTZ'2026-08-11 00:00:00'), ('a2', 'x', TIMESTAMP_NTZ'2026-08-11 23:59:59'), ('a3', 'x', TIMESTAMP_NTZ'2026-08-12 00:00:00') AS t(article_id, source_id, publication_date)")
    out = sinks.export_rows(s, a, spark.createDataFrame([("x", "X")], "source_id string, name string"), "2026-08-11", "2026-08-11")
    assert {r.sentence_id for r in out.collect()} == {"s1", "s2"}


def test_bounded_reach(spark):
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (2, 3)], "src int, dst int")
    assert {r.node: r.depth for r in O.reachable(edges, spark.createDataFrame([(0,)], "node int"), 2).collect()} == {0: 0, 1: 1, 2: 2}


DATES = {
    "11 Aug 2026": "2026-08-11 00:00:00", "Aug 11, 2026 10:30 AM": "2026-08-11 10:30:00", "August 11, 2026 1:05 PM": "2026-08-11 13:05:00", "20260811": "2026-08-11 00:00:00",
    "2026-08-11T10:30Z": "2026-08-11 10:30:00", "20260811T103000": "2026-08-11 10:30:00", "20260811T1030+0800": "2026-08-11 02:30:00", "2026-W33-2": "2026-08-11 00:00:00", "2026-08-11T10": "2026-08-11 10:00:00",
    "2026-08-11T10:30:00+0800": "2026-08-11 02:30:00", "Tue, 11 Aug 2026 10:30:00 GMT": "2026-08-11 10:30:00", "2026/08/11": "2026-08-11 00:00:00", "08/11/2026": None, "31 Feb 2026": None, "2026-W54-1": None, "": None,
}


def test_date_forms(spark):
    rows = spark.createDataFrame([(k,) for k in DATES], "c string").select("c", S.parse_date(F.col("c")).cast("string").alias("d")).collect()
    assert {r.c: r.d for r in rows} == DATES
    assert {k: str(got) if (got := dates.utc(dates.parse(k))) else None for k in DATES} == DATES
    stamp = lambda x: F.lit(x).cast("timestamp_ntz")
    for raw, reason in ((None, "date_missing"), (" ", "date_missing"), ("soon", "date_invalid"), ("2019-01-01", "date_before_cutoff"), ("2026-08-11", "accepted"), ("2027-01-01", "date_in_future")):
        assert one(spark, lambda c: S.raw_date_reason(c, stamp("2020-01-01"), stamp("2026-08-12")), raw) == reason
    for value, wait in (("120", 120.0), ("Wed, 12 Aug 2026 00:01:00 GMT", 60.0), ("Mon, 10 Aug 2026 00:00:00 GMT", 0.0), ("x", None)):
        assert one(spark, lambda c: S.retry_after(c, stamp("2026-08-12")), value) == wait


def test_urls_that_do_not_decode(spark):
    cases = {"http://a.com/?q=100%&x=1": "http://a.com/?q=100%25&x=1", "http://a.com/?a=%zz&b=%20": "http://a.com/?a=%25zz&b=+"}
    assert {k: one(spark, U.normalize_url, k) for k in cases} == cases
    for url, bad in (("http://a/?x", True), ("http://a/?utm_source=1", False), ("http://a/?&", True), ("http://a/", False)):
        assert one(spark, U.disallowed_query, url) is bad
    none = F.lit(None).cast("array<string>")
    assert one(spark, lambda c: U.accepts_sitemap(c, F.lit("www.a.com"), F.array(F.lit("cdn.a.com"))), "https://cdn.a.com/s.xml") and not one(spark, lambda c: U.accepts_sitemap(c, F.lit("a.com"), none), "ftp://a.com/s")
    for pattern, shared, fine in (("a.com/n/*", True, True), ("a.com/*", True, False), ("a.com/*", False, True), ("b.com/*", False, False), ("a.com/x?y", False, False)):
        assert one(spark, lambda c: U.safe_index_pattern(c, F.lit("a.com"), F.lit(shared)), pattern) is fine
    period = [F.lit(x) for x in ("2026", "08", "11", "2026-08-11")]
    assert one(spark, lambda c: U.archive_urls(c, F.lit("/n/"), none, "day", *period), "a.com") == ["https://a.com/n/2026/08/11/"]
    assert one(spark, lambda c: U.archive_urls(c, F.lit(""), F.array(F.lit("http://{domain}/{date_iso}"), F.lit("{odd}")), "day", *period), "a.com") == ["http://a.com/2026-08-11"]
    text = F.lit(None).cast("string")
    assert [one(spark, lambda c: U.page_url(c, F.lit(n), t), u) for u, n, t in (("http://a/x/", 1, text), ("http://a/x/", 2, text), ("http://a/x?d=1", 2, text), ("http://a/x", 3, F.lit("{url},{page}")))] == ["http://a/x/", "http://a/x/page/2", "http://a/x?d=1&page=2", "http://a/x,3"]


def test_long_address_is_no_boundary(spark):
    for n in (10, 1000):
        address = "https://a.com/" + "x" * n + ".y."
        assert [s["text"] for s in one(spark, T.sentences, f"Basahin sa {address} Tapos na. Oo! Sa www.b.com/c.d?e=1 ito.")] == [f"Basahin sa {address} Tapos na.", "Oo!", "Sa www.b.com/c.d?e=1 ito."]
    assert one(spark, lambda c: T.normalize_text(c, compose=True), "é­  a") == "é a"


def test_feeds_with_foreign_fields_and_faults():
    rss = b"""<rss xmlns:media="http://search.yahoo.com/mrss/" xmlns:atom="http://www.w3.org/2005/Atom"><channel><title>C</title><atom:link href="http://a/feed" rel="self"/>
    <item><media:title>wrong</media:title><title>Tom & Jerry &eacute;</title><link>http://a/1?x=1&y=2</link><pubDate>Tue, 11 Aug 2026 12:00:00 +0800</pubDate></item><item><title>two</title><guid>http://a/2</guid></item></channel></rss>"""
    got = feeds.parse_feed(rss)
    assert got["kind"] == "RSS" and got["error"] and [e["title"] for e in got["entries"]] == ["Tom & Jerry é", "two"]
    assert [e["url"] for e in got["entries"]] == ["http://a/1?x=1&y=2", "http://a/2"] and got["entries"][0]["published"] == datetime(2026, 8, 11, 4)
    atom = b"""<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>T</title><link rel="enclosure" href="http://a/x.mp3"/><link rel="alternate" href="http://a/1"/><updated>2026-08-11T00:00:00Z</updated></entry></feed>"""
    assert feeds.parse_feed(atom)["kind"] == "ATOM" and feeds.parse_feed(atom)["entries"][0]["url"] == "http://a/1"
    assert feeds.parse_feed(b"<foo/>")["kind"] == "MALFORMED"
    assert len(feeds.parse_feed(b"<rss><channel><item><title>a</title></item><item><title>b</broken></item><item><title>c</title></item>")["entries"]) == 2
    sitemap = b"""<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:image="i" xmlns:news="n"><url><loc>http://a/1</loc><lastmod>2026-08-11T08:00:00+08:00</lastmod>
    <image:image><image:loc>http://a/i.jpg</image:loc></image:image><news:news><news:publication_date>2026-08-10</news:publication_date></news:news></url></urlset>"""
    want = [{"url": "http://a/1", "lastmod": datetime(2026, 8, 11), "published": datetime(2026, 8, 10)}]
    assert feeds.parse_sitemap(sitemap)["urls"] == want and feeds.parse_sitemap(sitemap, encoding="gzip")["urls"] == want
    assert feeds.parse_sitemap(gzip.compress(sitemap), "http://a/s.xml.gz")["urls"] == want
    assert feeds.parse_sitemap(b"plain", "http://a/s.xml.gz")["error"].startswith("decompression_failed") and feeds.parse_sitemap(b"")["error"] == "empty_content"


def test_article_body_and_dates():
    page = """<html><head><meta property="article:published_time" content="not a date"><meta property="og:title" content="Head"></head><body><nav><p>Menu</p></nav>
    <div class="related"><p>A very long list of related links that is longer than the body itself</p></div><div class="entry-content"><p>Una.<p class="caption">Larawan</p><div class="byline"><p>Ni X</p></div><p>Ikalawa <b>ito</b>.</p></div>
    <time datetime="2026-08-11">x</time><aside><p>Side</p></aside></body></html>"""
    got = html.extract(page, "http://a/")
    assert (got["body"], got["body_selector"], got["published"], got["date_source"], got["headline"]) == ("Una.\nIkalawa ito .", ".entry-content", "2026-08-11", "selector", "Head")
    own = html.extract('<div id="main"><span class="when">Aug 11, 2026</span><p>Una.</p></div><article><p>Iba ito.</p></article>', "", "#main", ".when")
    assert (own["body"], own["date_source"], own["published"]) == ("Una.", "selector", "Aug 11, 2026")
    assert html.extract("<article><div>isa</div><div>dalawa</div></article>")["body"] == "isa\ndalawa"
    listing = html.tree('<div class="list"><h2><a href="/1">x</a></h2><h2><a href="/2">y</a></h2><h2>z</h2></div><li class="next"><a href="?page=2">next</a></li>')
    assert html.select_links(listing, ".list h2", "http://a/x") == ["http://a/1", "http://a/2"] and html.next_link(listing, ".next", "http://a/x") == "http://a/x?page=2"


def test_robots_and_caches(spark):
    urls = spark.createDataFrame([("http://www.a.com/x/1",), ("http://www.a.com/y",), ("http://b.com/",), ("http://c.com/",)], "url string")
    at = "TIMESTAMP_NTZ'2026-08-11 00:00:00'"
    robots = spark.sql(f"SELECT * FROM VALUES ('www.a.com', 200, 'User-agent: *\nDisallow: /x\nCrawl-delay: 7', {at}), ('b.com', 403, NULL, {at}), ('c.com', 200, 'User-agent: *\nDisallow: /', {at} - INTERVAL 3 DAYS) AS t(domain, status, text, at)")
    got = {r.url: (r.allowed, r.delay) for r in feeds.robots_decisions(urls, robots, "bot", F.expr(at)).collect()}
    assert got == {"http://www.a.com/x/1": (False, 7.0), "http://www.a.com/y": (True, 7.0), "http://b.com/": (False, None), "http://c.com/": (True, None)}
    responses = spark.createDataFrame([('{"a":1}', bytearray(b"one")), ('{"a":2}', bytearray(b"two"))], "request string, content binary")
    cache = feeds.cache_entries(responses).withColumn("byte_count", F.when(F.col("request") == '{"a":2}', 9).otherwise(F.col("byte_count")).cast("bigint"))
    found = {r.request: r.content and bytes(r.content) for r in feeds.cache_lookup(spark.createDataFrame([('{"a":1}',), ('{"a":2}',), ('{"a":3}',)], "request string"), cache).collect()}
    assert found == {'{"a":1}': b"one", '{"a":2}': None, '{"a":3}': None}
    assert [one(spark, feeds.index_pages, x) for x in ('{"pages": 3}', "4", '{"pages": -1}', "x")] == [3, 4, None, None]
    asked = feeds.index_requests(spark.createDataFrame([("a.com/*", 2)], "pattern string, pages int"), "CC-MAIN-2026-30").collect()
    assert [r.page for r in asked] == [0, 1] and len({r.key for r in asked}) == 2
    fetches = spark.createDataFrame([("u", 200, "old", "e1", None, 1), ("u", 200, "new", "e2", None, 2), ("v", 500, "", None, None, 1)], "url string, status int, body string, etag string, last_modified string, at int")
    bodies = feeds.body_cache(fetches)
    again = feeds.with_cached_bodies(spark.createDataFrame([("u", 304, None), ("v", 304, None)], "url string, status int, body string"), bodies).collect()
    assert {r.url: (r.status, r.body, r.from_cache) for r in again} == {"u": (200, "new", True), "v": (304, None, False)}
