"""RSS, Atom, sitemap, index and robots documents to rows. Bad input gives a kind, never an exception."""

from __future__ import annotations

import gzip
import re
import urllib.robotparser
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from datetime import datetime
from html import escape, unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse, utc
from ..functions.url import domain

_ENTITY = re.compile(r"&(?!#\d+;|#x[0-9A-Fa-f]+;|(?:amp|lt|gt|quot|apos);)(\w+;)?")
_ENTRY = re.compile(r"<(?:\w+:)?(item|entry)[\s>].*?</(?:\w+:)?\1\s*>", re.DOTALL | re.IGNORECASE)
#: Namespaces whose title, link and category are an entry's own; others (media, say) describe something else.
_OWN = ("", "http://www.w3.org/2005/Atom", "http://purl.org/atom/ns#", "http://purl.org/rss/1.0/", "http://backend.userland.com/rss2")
_DATES = (("pubdate", "published", "issued"), ("updated", "modified", "date"), ("created",))


def _name(node: ET.Element) -> tuple[str, str]:
    """Namespace and lower-cased local name."""
    space, _, local = node.tag.rpartition("}") if isinstance(node.tag, str) else ("", "", "")
    return space.lstrip("{"), local.lower()


def is_html(content: bytes | None) -> bool:
    head = (content or b"")[:2048].decode("utf-8", "ignore").lstrip().lower()
    return head.startswith(("<!doctype html", "<html")) or "<html" in head[:200]


def _plain(content: bytes, zipped: bool = False) -> bytes:
    """Without up to three layers of gzip; an error where it's said to be zipped and isn't."""
    for layer in range(3):
        if content[:2] != b"\x1f\x8b" and not (zipped and not layer):
            break
        content = gzip.decompress(content)
    return content


def _mended(raw: bytes) -> str:
    """With bare ampersands and entities that XML doesn't know as text."""
    text = raw.decode("utf-8", "replace")
    return _ENTITY.sub(lambda m: escape(unescape(m[0])) if m[1] and unescape(m[0]) != m[0] else "&amp;" + m[0][1:], text)


def _feed_root(raw: bytes) -> tuple[ET.Element | None, list[ET.Element], str | None]:
    """Root and entries of a feed; of one that isn't well-formed, the entries that are."""
    try:
        root = ET.fromstring(raw)
        return root, [x for x in root.iter() if _name(x)[1] in ("item", "entry")], None
    except ET.ParseError as e:
        error = str(e)
    text = _mended(raw)
    try:
        root = ET.fromstring(re.sub(r"^<\?xml[^>]*\?>", "", text.lstrip()))
        return root, [x for x in root.iter() if _name(x)[1] in ("item", "entry")], error
    except ET.ParseError:
        pass
    spaces = " ".join(sorted(set(re.findall(r"xmlns(?::\w+)?=(?:\"[^\"]*\"|'[^']*')", text))))
    entries = []
    for m in _ENTRY.finditer(text):
        try:
            entries.append(ET.fromstring(f"<_ {spaces}>{m[0]}</_>")[0])
        except ET.ParseError:
            continue
    return None, entries, error


def _link(entry: ET.Element) -> str | None:
    """The page's own link: an alternate one, else an RSS link's text, else a permanent guid."""
    plain, alternate, guid = None, None, None
    for child in entry:
        space, name = _name(child)
        text = (child.text or "").strip()
        if name == "link" and space in _OWN:
            if child.get("href") and child.get("rel", "alternate") == "alternate":
                alternate = alternate or child.get("href").strip()
            elif text and not child.get("href"):
                plain = plain or text
        elif name == "guid" and child.get("isPermaLink", "true").lower() == "true" and text.startswith("http"):
            guid = guid or text
    return plain or alternate or guid


def parse_feed(content: bytes | None) -> dict:
    """kind, error and entries (title, url, published as naive UTC, category) of an RSS or Atom document."""
    try:
        raw = _plain(content or b"").strip()
    except (OSError, EOFError) as e:
        return {"kind": "MALFORMED", "error": f"decompression_failed: {e}", "entries": []}
    if not raw:
        return {"kind": "MALFORMED", "error": "empty_content", "entries": []}
    if is_html(raw):
        return {"kind": "HTML", "error": "html_document", "entries": []}
    root, nodes, error = _feed_root(raw)
    entries = []
    for node in nodes:
        own: dict[str, str] = {}
        stamps: dict[str, str] = {}
        for child in node:
            space, name = _name(child)
            value = ("".join(child.itertext()) or child.get("term") or "").strip()
            if value and space in _OWN:
                own.setdefault(name, value)
            if value:
                stamps.setdefault(name, value)
        dates = (utc(parse(next((stamps[k] for k in group if k in stamps), None))) for group in _DATES)
        entries.append({"title": own.get("title"), "url": _link(node), "published": next((d for d in dates if d), None), "category": own.get("category")})
    name = _name(root)[1] if root is not None else ("feed" if any(_name(x)[1] == "entry" for x in nodes) else "rss")
    kind = "ATOM" if name == "feed" else "RSS" if name in ("rss", "rdf") or entries else "MALFORMED"
    if root is None and not entries:
        kind = "MALFORMED"
    return {"kind": kind, "error": error, "entries": entries}


def _iso(text: str | None):
    """An ISO date as naive UTC."""
    try:
        return utc(datetime.fromisoformat((text or "").strip().replace("Z", "+00:00")))
    except ValueError:
        return None


def parse_sitemap(content: bytes | None, url: str | None = None, encoding: str | None = None) -> dict:
    """kind, child sitemaps and urls (url, lastmod, published) of a sitemap document.

    It's taken as zipped by its first bytes, its URL's ending or its encoding header, the header aside where the
    content is XML already.
    """
    empty = {"sitemaps": [], "urls": []}
    raw = content or b""
    if not raw:
        return {"kind": "unknown", **empty, "error": "empty_content"}
    if is_html(raw):
        return {"kind": "html", **empty, "error": "html_document"}
    header = "gzip" in (encoding or "").lower() and not raw.lstrip().startswith(b"<")
    try:
        raw = _plain(raw, zipped=header or (url or "").lower().endswith(".gz"))
    except (OSError, EOFError) as e:
        return {"kind": "malformed", **empty, "error": f"decompression_failed: {e}"}
    try:
        root = ET.fromstring(raw.strip())
    except ET.ParseError as e:
        return {"kind": "malformed", **empty, "error": f"malformed_xml: {e}"}
    kind = {"sitemapindex": "index", "urlset": "urlset"}.get(_name(root)[1], "unknown")
    out = {"kind": kind, "sitemaps": [], "urls": [], "error": None if kind != "unknown" else f"unsupported_root_element: {root.tag}"}
    wanted = {"index": "sitemap", "urlset": "url"}.get(kind)
    for node in root.iter():
        if _name(node)[1] != wanted:
            continue
        own: dict[str, str] = {}
        for child in node:
            own.setdefault(_name(child)[1], (child.text or "").strip())
        if not own.get("loc"):
            continue
        if kind == "index":
            out["sitemaps"].append(own["loc"])
        else:
            news = next((x.text for x in node.iter() if _name(x)[1] == "publication_date" and x.text), None)
            out["urls"].append({"url": own["loc"], "lastmod": _iso(own.get("lastmod")), "published": _iso(news)})
    return out


def _mapped(df: DataFrame, key: str, column: str, parse, fields: dict[str, tuple[str, pa.DataType]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [parse(x) for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array([r[f] for r in rows], t) for f, (_, t) in fields.items())], names=[key, *fields])

    return df.select(key, column).mapInArrow(run, f"{key} {dict(df.dtypes)[key]}, " + ", ".join(f"{f} {s}" for f, (s, _) in fields.items()))


def read_feeds(df: DataFrame, key: str = "root", column: str = "content") -> DataFrame:
    entry = pa.struct([("title", pa.string()), ("url", pa.string()), ("published", pa.timestamp("us")), ("category", pa.string())])
    return _mapped(df, key, column, parse_feed, {"kind": ("string", pa.string()), "error": ("string", pa.string()), "entries": ("array<struct<title string, url string, published timestamp_ntz, category string>>", pa.list_(entry))})


def read_sitemaps(df: DataFrame, key: str = "root", column: str = "content") -> DataFrame:
    url = pa.struct([("url", pa.string()), ("lastmod", pa.timestamp("us")), ("published", pa.timestamp("us"))])
    return _mapped(df, key, column, parse_sitemap, {"kind": ("string", pa.string()), "sitemaps": ("array<string>", pa.list_(pa.string())), "urls": ("array<struct<url string, lastmod timestamp_ntz, published timestamp_ntz>>", pa.list_(url)), "error": ("string", pa.string())})


def index_outcome(line: Column) -> Column:
    """blank, malformed, invalid or candidate, for a line of an index response."""
    parsed = F.try_parse_json(line)
    url = F.try_variant_get(parsed, "$.url", "string")
    return F.when(F.trim(line) == "", "blank").when(parsed.isNull(), "malformed").when(F.trim(F.coalesce(url, F.lit(""))) == "", "invalid").otherwise("candidate")


def read_index(lines: DataFrame, column: str = "value") -> DataFrame:
    """url, timestamp, status, mime and outcome of the lines of an index response."""
    get = lambda k: F.try_variant_get(F.try_parse_json(column), f"$.{k}", "string").alias(k)
    return lines.select(*(get(k) for k in ("url", "timestamp", "status", "mime")), index_outcome(F.col(column)).alias("outcome"))


def index_pages(response: Column) -> Column:
    """How many pages an index says it has: {"pages": n} or n; null where it's neither or negative."""
    parsed = F.try_parse_json(response)
    n = F.coalesce(F.try_variant_get(parsed, "$.pages", "bigint"), F.when(F.trim(response).rlike(r"^\d+$"), F.trim(response).try_cast("bigint")))
    return F.when(n >= 0, n)


def index_requests(patterns: DataFrame, collection: str, pages: str = "pages") -> DataFrame:
    """A request (pattern, page, params as JSON, key) for each page of each pattern; key names it in the cache."""
    rows = patterns.where(F.col(pages) > 0).select("pattern", F.explode(F.sequence(F.lit(0), F.col(pages).cast("int") - 1)).alias("page"))
    params = F.to_json(F.struct(F.lit(collection).alias("collection"), F.lit("json").alias("output"), F.col("page"), F.col("pattern").alias("url")))
    return rows.withColumn("params", params).withColumn("key", cache_key(F.col("params")))


def cache_key(request: Column) -> Column:
    """A cached response's key: SHA-256 of its request's JSON, whose fields stand in order of name."""
    return F.sha2(request, 256)


def cache_entries(responses: DataFrame) -> DataFrame:
    """key, version, request, body (base64), byte_count and sha256 of responses (request JSON, content binary)."""
    return responses.select(cache_key(F.col("request")).alias("key"), F.lit(1).alias("version"), "request", F.base64("content").alias("body"), F.length("content").cast("bigint").alias("byte_count"), F.sha2("content", 256).alias("sha256"))


def cache_lookup(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """requests with content: the cached bytes, null where there's no entry or it doesn't hold what it says."""
    good = cache.where((F.col("version") == 1) & cache_valid(F.col("key"), F.col("body"), F.col("sha256"), F.col("byte_count")) & (F.col("key") == cache_key(F.col("request"))))
    return requests.withColumn("key", cache_key(F.col("request"))).join(good.select("key", F.unbase64("body").alias("content")).dropDuplicates(["key"]), "key", "left")


def cache_valid(key: Column, body: Column, digest: Column, size: Column) -> Column:
    """Whether a cached response's body has its recorded digest and size."""
    raw = F.unbase64(body)
    return key.isNotNull() & (F.sha2(raw, 256) == digest) & (F.length(raw) == size)


def body_cache(fetches: DataFrame) -> DataFrame:
    """The last good body of each URL, with what a conditional request needs; fetches: url, status, body, etag, last_modified, at."""
    last = fetches.where("status = 200").groupBy("url").agg(F.max_by(F.struct("body", "etag", "last_modified", "at"), "at").alias("x"))
    return last.select(F.sha2("url", 256).alias("key"), "url", "x.*")


def with_cached_bodies(fetches: DataFrame, cache: DataFrame) -> DataFrame:
    """fetches with status and body as the crawl sees them: 304 is 200 with the cached body."""
    old = cache.select("url", F.col("body").alias("_cached"))
    hit = (F.col("status") == 304) & F.col("_cached").isNotNull()
    joined = fetches.join(old, "url", "left").withColumn("from_cache", F.coalesce(hit, F.lit(False)))
    return joined.withColumn("body", F.when(F.col("from_cache"), F.col("_cached")).otherwise(F.col("body"))).withColumn("status", F.when(F.col("from_cache"), 200).otherwise(F.col("status"))).drop("_cached")


def _rules(status: int | None, text: str | None) -> urllib.robotparser.RobotFileParser | bool:
    """404 and failures allow all, 403 forbids all, else the rules decide."""
    if status == 403:
        return False
    if status != 200:
        return True
    rules = urllib.robotparser.RobotFileParser()
    rules.parse((text or "").splitlines())
    return rules


def robots_allows(status: int, text: str | None, agent: str, url: str) -> bool:
    rules = _rules(status, text)
    return rules if isinstance(rules, bool) else rules.can_fetch(agent, url)


def robots_delay(status: int, text: str | None, agent: str) -> float | None:
    rules = _rules(status, text)
    delay = None if isinstance(rules, bool) else rules.crawl_delay(agent)
    return None if delay is None else float(delay)


def robots_decisions(urls: DataFrame, robots: DataFrame, agent: str, as_of=None, ttl: str = "24 hours") -> DataFrame:
    """urls with allowed and delay; robots: domain, status, text, at. Of a domain the newest file within the TTL counts,
    without one all is allowed."""
    newest = robots if as_of is None else robots.where((F.col("at") <= as_of) & (F.col("at") > as_of - F.expr(f"INTERVAL {ttl}")))
    files = newest.groupBy("domain").agg(F.max_by(F.struct("status", "text"), "at").alias("_robots"))
    rows = urls.withColumn("_domain", domain(F.col("url"), www=True)).join(files.withColumnRenamed("domain", "_domain"), "_domain", "left").drop("_domain")
    names = urls.columns

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            allowed, delays, seen = [], [], {}
            for url, file in zip(batch.column("url").to_pylist(), batch.column("_robots").to_pylist(), strict=True):
                pair = (file["status"], file["text"]) if file else (404, None)
                rules = seen.setdefault(pair, _rules(*pair))
                allowed.append(rules if isinstance(rules, bool) else rules.can_fetch(agent, url or ""))
                delay = None if isinstance(rules, bool) else rules.crawl_delay(agent)
                delays.append(None if delay is None else float(delay))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(allowed, pa.bool_()), pa.array(delays, pa.float64())], names=[*names, "allowed", "delay"])

    return rows.mapInArrow(decide, f"{', '.join(f'`{n}` {t}' for n, t in urls.dtypes)}, allowed boolean, delay double")


def robots_sitemaps(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), 1))


def archive_periods(spark, start: str, end: str, granularity: str, most: int = 1000) -> DataFrame:
    """period, yyyy, mm, dd and date_iso of each year, month or day from start to end."""
    unit = {"year": "YEAR", "month": "MONTH", "day": "DAY"}[granularity]
    days = spark.sql(f"SELECT explode(sequence(CAST(date_trunc('{unit}', DATE'{start}') AS DATE), CAST(date_trunc('{unit}', DATE'{end}') AS DATE), INTERVAL 1 {unit})) AS period")
    return days.orderBy("period").limit(most).select("period", F.date_format("period", "yyyy").alias("yyyy"), F.date_format("period", "MM").alias("mm"), F.date_format("period", "dd").alias("dd"), F.date_format("period", "yyyy-MM-dd").alias("date_iso"))
