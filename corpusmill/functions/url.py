"""URL columns: normal form, source scope, dates in paths. All are native expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tracking parameters, asset endings and utility path segments.
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "yclid", "_hsenc", "_hsmi", "mc_cid", "mc_eid"]
ASSETS = "7z avi css csv doc docx gif ico jpeg jpg js json mp3 mp4 pdf png svg tar txt webm webp woff woff2 xml zip".split()
UTILITY = "admin author feed feeds login logout search share sitemap tag tags wp-admin wp-json".split()

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def parts(c: Column) -> dict[str, Column]:
    """scheme and netloc in lower case, path and query as they stand."""
    clean = F.trim(c)
    get = lambda i: F.regexp_extract(clean, _PARTS, i)
    return {"scheme": F.lower(get(1)), "netloc": F.lower(get(2)), "path": get(3), "query": get(4)}


def decoded(c: Column) -> Column:
    """Percent-decoded; a % that begins no escape stands for itself."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")), c)


def domain(c: Column, www: bool = False) -> Column:
    """The host of a URL or bare host, in lower case, without port and, unless www, without a leading www."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"^[a-z][a-z0-9+.-]*://", ""), r"[/?#].*$", "")
    host = F.regexp_replace(F.regexp_replace(bare, "^.*@", ""), r":\d*$", "")
    return host if www else F.regexp_replace(host, r"^www\.", "")


def disallowed_query(c: Column, allowed: bool = False) -> Column:
    """Whether the query holds more than tracking parameters (blank ones count), or no parameter at all."""
    query = parts(c)["query"]
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.lower(decoded(F.substring_index(x, "=", 1))))
    return F.lit(not allowed) & (query != "") & ((F.size(keys) == 0) | F.exists(keys, lambda k: ~k.isin(TRACKING)))


def accepts_sitemap(c: Column, host: Column, allowed: Column) -> Column:
    """Whether a sitemap's URL is http(s) and on the source's host or an allowed one; allowed: array<string>."""
    hosts = F.transform(F.concat(F.array(host), F.coalesce(allowed, F.array().cast("array<string>"))), lambda h: domain(h))
    return parts(c)["scheme"].isin("http", "https") & F.array_contains(hosts, domain(c))


def safe_index_pattern(c: Column, host: Column, shared: Column) -> Column:
    """Whether a pattern may be asked of an index: http(s) or bare, the source's host, no query, fragment or
    parameters, and on a shared host more than a wildcard."""
    full = F.when(c.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.trim(c)).otherwise(F.concat(F.lit("https://"), F.trim(c)))
    p = parts(full)
    own = p["scheme"].isin("http", "https") & (domain(full) == domain(host)) & ~full.rlike(r"[?#;]")
    return F.coalesce(own & ~(shared & p["path"].rlike(r"^[/*]*$")), F.lit(False))


def archive_urls(base: Column, prefix: Column, templates: Column, granularity: str, yyyy: Column, mm: Column, dd: Column, date_iso: Column) -> Column:
    """array<string>: a period's URLs by a source's templates, or by granularity without any.

    A template with a field that isn't known is left out.
    """
    fields = {"{domain}": base, "{url_prefix}": prefix, "{yyyy}": yyyy, "{mm}": mm, "{dd}": dd, "{date_iso}": date_iso, "{year}": yyyy.cast("int").cast("string"), "{month}": mm.cast("int").cast("string"), "{day}": dd.cast("int").cast("string")}
    tail = {"year": "{yyyy}/", "month": "{yyyy}/{mm}/", "day": "{yyyy}/{mm}/{dd}/"}[granularity]
    own = F.concat(F.regexp_replace(F.concat(F.lit("https://"), F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(F.coalesce(prefix, F.lit("")), "^/+|/+$", "")), "/+$", ""), F.lit("/" + tail))
    some = F.when(F.size(F.coalesce(templates, F.array().cast("array<string>"))) > 0, templates).otherwise(F.array(own))

    def filled(t: Column) -> Column:
        for k, v in fields.items():
            t = F.replace(t, F.lit(k), F.coalesce(v, F.lit("")))
        return t

    return F.filter(F.transform(some, filled), lambda t: ~t.rlike(r"[{}]"))


def page_url(base: Column, page: Column, template: Column) -> Column:
    """The URL of a further page of a listing."""
    filled = F.replace(F.replace(template, F.lit("{url}"), F.regexp_replace(base, "/+$", "")), F.lit("{page}"), page.cast("string"))
    usual = F.when(base.contains("?"), F.concat(base, F.lit("&page="), page.cast("string"))).otherwise(F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/page/"), page.cast("string")))
    return F.when(page <= 1, base).when(template.isNotNull() & ~filled.rlike(r"[{}]"), filled).otherwise(usual)


def normalize_url(c: Column) -> Column:
    """One spelling per page: case, default ports, tracking and blank parameters, order, slashes, fragment."""
    p = parts(c)
    host = F.when(p["scheme"] == "https", F.regexp_replace(p["netloc"], ":443$", "")).when(p["scheme"] == "http", F.regexp_replace(p["netloc"], ":80$", "")).otherwise(p["netloc"])
    pairs = F.transform(F.filter(F.split(p["query"], "&"), lambda x: x.rlike("^[^=]*=.")), lambda x: F.named_struct(F.lit("k"), decoded(F.substring_index(x, "=", 1)), F.lit("v"), decoded(F.regexp_replace(x, "^[^=]*=", ""))))
    kept = F.array_sort(F.filter(pairs, lambda x: ~F.lower(x["k"]).isin(TRACKING)))
    quote = lambda x: F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    query = F.array_join(F.transform(kept, lambda x: F.concat(quote(x["k"]), F.lit("="), quote(x["v"]))), "&")
    path = F.when(p["path"].isin("", "/"), "/").otherwise(F.regexp_replace(p["path"], "/+$", ""))
    full = F.concat(F.when(p["scheme"] != "", F.concat(p["scheme"], F.lit(":"))).otherwise(""), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(""), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(F.coalesce(c, F.lit("")) == "", "").otherwise(full)


@dataclass(frozen=True)
class Source:
    """A source's scope: its host, an optional path prefix, article patterns, landing pages and siblings."""

    id: str
    domain: str
    prefix: str = ""
    patterns: tuple[str, ...] = ()
    landing: tuple[str, ...] = ()
    siblings: tuple[str, ...] = ()
    enabled: bool = True
    policy: str = field(default="default")


def is_asset(path: Column, query: Column) -> Column:
    clean = F.lower(F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path))
    return clean.rlike(rf"\.(?:{'|'.join(ASSETS)})$") | clean.rlike(rf"(?:^|/)(?:{'|'.join(UTILITY)})(?:/|$)") | F.lower(query).rlike("^(?:s|q|search)=")


def _scoped(c: Column, own: Column, landing: Column, sibling, fits) -> Column:
    """The first of the ordered reasons; sibling and fits get the cleaned and the raw path."""
    p = parts(c)
    host = domain(p["netloc"])
    clean = F.when(F.regexp_replace(p["path"], "/+$", "") == "", "/").otherwise(F.regexp_replace(p["path"], "/+$", ""))
    raw = F.when(p["path"] == "", "/").otherwise(p["path"])
    return (
        F.when(F.trim(F.coalesce(c, F.lit(""))) == "", "invalid_url")
        .when((p["scheme"] == "") | (host == ""), "invalid_url")
        .when(~p["scheme"].isin("http", "https"), "unsupported_scheme")
        .when(own.isNull() | (host != domain(own)), "host_mismatch")
        .when(is_asset(p["path"], p["query"]), "non_article_asset")
        .when(F.array_contains(landing, clean), "section_landing_page")
        .when(sibling(clean), "cross_brand")
        .when(~fits(clean, raw), "path_pattern_mismatch")
        .otherwise("accepted")
    )


def scope_reason(c: Column, source: Source) -> Column:
    """The first of the ordered reasons that decides whether a URL is an article of the source."""
    prefix = "/" + source.prefix.strip("/") if source.prefix else None
    landing = {"/", *source.landing, *([prefix.rstrip("/") or "/"] if prefix else [])}

    def any_of(columns: list[Column]) -> Column:
        out = F.lit(False)
        for x in columns:
            out = out | x
        return out

    def fits(clean: Column, raw: Column) -> Column:
        if source.patterns:
            return any_of([raw.rlike(f"^(?:{p})$") for p in source.patterns])
        return clean.startswith(prefix.rstrip("/") + "/") if prefix else F.lit(True)

    return _scoped(c, F.lit(source.domain), F.array(*map(F.lit, sorted(landing))), lambda path: any_of([x for s in source.siblings for x in (F.lower(path) == s, F.lower(path).startswith(s + "/"))]), fits)


def scope_reason_by_row(c: Column, domain_: str = "domain", prefix: str = "prefix", patterns: str = "patterns", landing: str = "landing", siblings: str = "siblings") -> Column:
    """As scope_reason, with the source's scope in columns of the row, as a join to the sources gives them."""
    none = F.array().cast("array<string>")
    some = lambda k: F.coalesce(F.col(k), none)
    start = F.concat(F.lit("/"), F.regexp_replace(F.coalesce(F.col(prefix), F.lit("")), "^/+|/+$", ""))
    home = F.concat(some(landing), F.array(F.lit("/"), start))

    def fits(clean: Column, raw: Column) -> Column:
        by_pattern = F.exists(some(patterns), lambda p: F.regexp_like(raw, F.concat(F.lit("^(?:"), p, F.lit(")$"))))
        return F.when(F.size(some(patterns)) > 0, by_pattern).otherwise((start == "/") | clean.startswith(F.concat(start, F.lit("/"))))

    return _scoped(c, F.col(domain_), home, lambda path: F.exists(some(siblings), lambda s: (F.lower(path) == s) | F.lower(path).startswith(F.concat(s, F.lit("/")))), fits)


def url_date(c: Column) -> Column:
    """The date in a path such as /2026/08/11/, null where there's none or it's impossible."""
    pattern = r"(?:^|/)(20\d{2})[-/](0?[1-9]|1[0-2])[-/](0?[1-9]|[12]\d|3[01])(?:/|$)"
    y, m, d = (F.nullif(F.regexp_extract(c, pattern, i), F.lit("")) for i in (1, 2, 3))
    return F.try_to_timestamp(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")
