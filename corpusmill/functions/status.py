"""Fetch status, retry delays, the URL life cycle and date checks as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRANSIENT = (202, 408, 425, 429, 500, 502, 503, 504)
#: Order of trust in date evidence; others come last.
EVIDENCE_RANKS = {"html_jsonld": 1, "html_meta": 1, "html_selector": 1, "news_sitemap": 2, "rss": 3, "url": 4, "archive_period": 5, "lastmod": 6}


def http_category(status: Column) -> Column:
    return F.when(status.isin(200, 304), "SUCCESS").when(status == 429, "RATE_LIMITED").when(status == 403, "FORBIDDEN").when(status.isin(*[s for s in TRANSIENT if s != 429]), "HTTP_TRANSIENT").otherwise("HTTP_ERROR")


def backoff(attempt: Column, initial: float = 2.0, factor: float = 2.0, most: float = 300.0) -> Column:
    """Seconds before a retry, without jitter."""
    return F.when(attempt <= 0, F.lit(0.0)).otherwise(F.least(F.lit(initial) * F.pow(F.lit(factor), attempt - 1), F.lit(most)))


def next_state(status: Column, retries: Column, retry_after: Column, max_retries: int = 3, max_forbidden: int = 1, cooldown: float = 3600.0) -> Column:
    """struct<state, reason, retries, delay> after a fetch of a URL in PROCESSING."""

    def to(state: str, reason: str | None = None, more: int = 0, delay: Column | None = None) -> Column:
        return F.struct(F.lit(state).alias("state"), F.lit(reason).cast("string").alias("reason"), (retries + more).cast("int").alias("retries"), (F.lit(None) if delay is None else delay).cast("double").alias("delay"))

    wait = F.greatest(backoff(retries + 1), F.coalesce(retry_after, F.lit(0.0)))
    return (
        F.when(status.isin(200, 304), to("DOWNLOADED"))
        .when(status.isin(*TRANSIENT) & (retries < max_retries), to("RETRY_WAIT", "http_transient", 1, wait))
        .when(status.isin(*TRANSIENT), to("TERMINAL_FAILED", "retry_exhausted"))
        .when((status == 403) & (retries < max_forbidden), to("RETRY_WAIT", "forbidden_retry", 1, F.when(retry_after > 0, retry_after).otherwise(cooldown)))
        .when(status == 403, to("BLOCKED", "forbidden"))
        .otherwise(to("TERMINAL_FAILED", "http_permanent"))
    )


def date_reason(value: Column, cutoff: Column, as_of: Column) -> Column:
    return F.when(value.isNull(), "date_missing").when(value > as_of + F.expr("INTERVAL 1 DAY"), "date_in_future").when(value < cutoff, "date_before_cutoff").otherwise("accepted")


#: A time with a zone has to have its seconds.
_NO_SECONDS = r"([T ]\d{2}:\d{2})(Z|[+-].*)$"


def let(value: Column, f) -> Column:
    """f of a value that's evaluated once; inlined in each place, long expressions would outgrow generated code."""
    return F.element_at(F.transform(F.array(value), f), 1)


def parse_date(c: Column) -> Column:
    """A date text as UTC: ISO forms (basic and week forms too), RFC 2822 (its weekday set aside), and written forms."""
    return let(F.regexp_replace(F.trim(c), r"^[A-Za-z]{3},\s*", ""), _parsed)


def _parsed(text: Column) -> Column:
    zone = r"(Z|[+-]\d{2}(:?\d{2})?)?$"
    whole = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?" + zone[:-1] + ")?$"), text)
    padded = F.regexp_replace(F.regexp_replace(whole, r"^(\S{10}[T ]\d{2})(Z|[+-].*)?$", "$1:00$2"), r"([+-]\d{2})(\d{2})$", "$1:$2")
    iso = F.try_to_timestamp(F.regexp_replace(padded, _NO_SECONDS, "$1:00$2"))
    basic = F.when(text.rlike(r"^\d{8}(T\d{4}(\d{2})?" + zone[:-1] + ")?$"), text)
    basic = F.regexp_replace(basic, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    basic = F.regexp_replace(F.regexp_replace(basic, r"T(\d{2})(\d{2})(\d{2})?", "T$1:$2:$3"), r":(?=$|[Z+-])", "")
    basic = F.regexp_replace(F.regexp_replace(basic, r"(T.*[+-]\d{2})(\d{2})$", "$1:$2"), _NO_SECONDS, "$1:00$2")
    week = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?$"
    part = lambda i: F.regexp_extract(text, week, i).try_cast("int")
    monday = F.date_trunc("week", F.make_date(part(1), F.lit(1), F.lit(4)))
    by_week = F.when(text.rlike(week) & part(2).between(1, 53), F.date_add(monday.cast("date"), (part(2) - 1) * 7 + F.coalesce(part(3), F.lit(1)) - 1).cast("timestamp"))
    by_week = F.when(F.weekofyear(by_week) == part(2), by_week)  # not every year has a week 53
    forms = ["d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm z", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy h:mm a", "MMM d, yyyy h:mm a", "yyyy/M/d"]
    return F.coalesce(iso, F.try_to_timestamp(basic), by_week, *(F.try_to_timestamp(text, F.lit(f)) for f in forms)).cast("timestamp_ntz")


def raw_date_reason(raw: Column, cutoff: Column, as_of: Column) -> Column:
    """As date_reason for a date text; date_invalid where it's no date."""
    judged = let(parse_date(raw), lambda d: F.when(d.isNull(), "date_invalid").otherwise(date_reason(d, cutoff, as_of)))
    return F.when(F.trim(F.coalesce(raw, F.lit(""))) == "", "date_missing").otherwise(judged)


def retry_after(value: Column, as_of: Column) -> Column:
    """Seconds that a Retry-After header asks for: a number, or an HTTP date less the time now (0 if past)."""
    wait = let(parse_date(value), lambda until: F.when(until.isNotNull(), F.greatest(F.lit(0.0), F.timestamp_diff("SECOND", as_of, until).cast("double"))))
    return F.when(F.trim(value).rlike(r"^\d+(\.\d+)?$"), F.trim(value).try_cast("double")).otherwise(wait)


def evidence(html: Column, html_source: Column, news: Column, rss: Column, url: Column, period: Column, lastmod: Column, hint: Column) -> Column:
    """array<struct<source, value, confidence>> of a page's date evidence, in order of trust; a hint only if its value is new."""
    known = [(html_source, html, 1.0), (F.lit("news_sitemap"), news, 0.9), (F.lit("rss"), rss, 0.85), (F.lit("url"), url, 0.75), (F.lit("archive_period"), period, 0.7), (F.lit("lastmod"), lastmod, 0.5)]
    rows = F.filter(F.array(*[F.struct(s.alias("source"), v.cast("timestamp_ntz").alias("value"), F.lit(c).alias("confidence")) for s, v, c in known]), lambda x: x["value"].isNotNull())
    extra = F.array(F.struct(F.lit("hint").alias("source"), hint.cast("timestamp_ntz").alias("value"), F.lit(0.8).alias("confidence")))
    fresh = hint.isNotNull() & ~F.exists(rows, lambda x: x["value"] == hint.cast("timestamp_ntz"))
    return F.when(fresh, F.concat(rows, extra)).otherwise(rows)


def modified_date(html: Column, lastmod: Column) -> Column:
    """A page's own date of change, else its sitemap's."""
    return F.coalesce(html, lastmod)


def diagnostics(**fields: Column) -> Column:
    """The fields that aren't null as a JSON object, in order of name."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in sorted(fields.items())]))
