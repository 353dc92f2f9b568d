"""Source and run configuration: loading, checks, and the policy that holds for a source.

Checks are a table of rules over paths of a nested dictionary; every broken rule is reported.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, fields, replace
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions.url import Source


class ConfigError(ValueError):
    """What is wrong with a configuration, a line for each broken rule."""


@dataclass(frozen=True)
class Policy:
    """What sentences are accepted."""

    min_tokens: int = 3
    max_tokens: int = 100
    include_quotes: bool = False
    include_headlines: bool = False
    accepted_languages: tuple[str, ...] = ("FILIPINO",)
    min_confidence: float = 0.0
    allow_mixed: bool = False
    classify_mixed: bool = True
    min_quality_score: float = 0.0


#: The named profiles.
PROFILES = {
    "default": Policy(),
    "strict": Policy(6, 60, False, False, ("FILIPINO",), 0.85, False, True, 0.9),
    "balanced": Policy(4, 80, True, False, ("FILIPINO",), 0.70, False, True, 0.7),
    "recall": Policy(3, 120, True, True, ("FILIPINO", "MIXED"), 0.50, True, True, 0.5),
}


def at(tree: Any, path: str) -> Any:
    """The value at a dotted path, None where there's none."""
    for key in path.split("."):
        tree = tree.get(key) if isinstance(tree, dict) else None
    return tree


def resolve_policy(source: dict | None = None, config: dict | None = None) -> tuple[str, Policy]:
    """The profile's name and the policy of a source: its own profile, else the run's, with the source's overrides.

    A known profile stands as it is; the run's own values make up any other.
    """
    source, config = source or {}, config or {}
    name = source.get("policy_profile") or at(config, "policy.profile") or at(config, "sentence.policy_profile") or "default"
    if name in PROFILES and name != "default":
        base = PROFILES[name]
    else:
        paths = {"min_tokens": "sentence.min_tokens", "max_tokens": "sentence.max_tokens", "include_quotes": "sentence.include_quotes", "include_headlines": "sentence.include_headlines", "accepted_languages": "language.accepted", "min_confidence": "language.min_confidence", "allow_mixed": "language.allow_mixed", "classify_mixed": "language.classify_mixed", "min_quality_score": "quality.min_score"}
        base = replace(Policy(), **{k: v for k, p in paths.items() if (v := at(config, p)) is not None})
    own = {f.name: source[f.name] for f in fields(Policy) if source.get(f.name) is not None}
    policy = replace(base, **own)
    return name, replace(policy, accepted_languages=tuple(policy.accepted_languages))


def _text(v: Any) -> bool:
    return isinstance(v, str) and bool(v.strip())


def _count(least: int, most: float = float("inf")) -> Callable[[Any], bool]:
    return lambda v: isinstance(v, int) and not isinstance(v, bool) and least <= v <= most


def _number(least: float, most: float = float("inf")) -> Callable[[Any], bool]:
    return lambda v: isinstance(v, int | float) and not isinstance(v, bool) and least <= v <= most


def _each(check: Callable[[Any], bool]) -> Callable[[Any], bool]:
    return lambda v: all(map(check, [v] if isinstance(v, str) else v)) if isinstance(v, str | list | tuple) else False


def _regex(v: Any) -> bool:
    try:
        re.compile(v)
        return True
    except (re.error, TypeError):
        return False


def _day(v: Any) -> bool:
    try:
        date.fromisoformat(str(v))
        return len(str(v)) == 10
    except ValueError:
        return False


_FLAG = lambda v: isinstance(v, bool)
_TABLE = lambda v: isinstance(v, dict)
_SHARE = _number(0, 1)
Rule = tuple[str, Callable[[Any], bool], str]
#: Path, check of a value that's there, and what it must be.
SOURCE_RULES: list[Rule] = [
    ("crawl_delay_seconds", _number(0), "a number of at least 0"),
    ("max_concurrent", _count(1), "an integer of at least 1"),
    ("article_path_patterns", _each(lambda p: isinstance(p, str) and _regex(p)), "regular expressions"),
    ("allowed_hosts", _each(_text), "host names"),
    ("allowed_sitemap_hosts", _each(_text), "host names"),
    ("budgets", _TABLE, "a table"),
    *((f"budgets.{k}", _count(1), "a positive integer") for k in ("max_candidates", "max_depth", "max_documents", "max_response_bytes")),
    ("archive", _TABLE, "a table"),
    ("archive.granularity", lambda v: v in ("year", "month", "day"), "year, month or day"),
    ("archive.pagination_mode", lambda v: v in ("none", "page_template", "next_link"), "none, page_template or next_link"),
    *((f"archive.{k}", _count(1), "an integer of at least 1") for k in ("max_periods", "max_pages_per_period", "max_total_pages", "max_response_bytes", "max_candidates", "pagination_limit")),
    ("archive.start_date", _day, "a date, YYYY-MM-DD"),
    ("archive.end_date", _day, "a date, YYYY-MM-DD"),
    ("archive.url_pattern", _text, "a text"),
    ("link_discovery", _TABLE, "a table"),
    ("link_discovery.enabled", _FLAG, "true or false"),
    ("link_discovery.article_priority", _count(0, 10_000), "an integer from 0 to 10000"),
    ("common_crawl", _TABLE, "a table"),
    ("common_crawl.enabled", _FLAG, "true or false"),
    ("common_crawl.url_patterns", lambda v: isinstance(v, list) and all(map(_text, v)), "a list of patterns"),
    ("policy_profile", lambda v: v in PROFILES, "one of " + ", ".join(PROFILES)),
    ("min_tokens", _count(1), "a positive integer"),
    ("max_tokens", _count(1), "a positive integer"),
    ("min_confidence", _SHARE, "from 0 to 1"),
    ("min_quality_score", _SHARE, "from 0 to 1"),
]
RUN_RULES: list[Rule] = [
    ("crawl.cutoff_date", _day, "a date, YYYY-MM-DD"),
    ("crawl.batch_size", _count(1), "a positive integer"),
    ("crawl.max_retries", _count(0), "an integer of at least 0"),
    ("link_discovery.max_depth", _count(0, 10), "an integer from 0 to 10"),
    *((f"link_discovery.{k}", _count(1), "a positive integer") for k in ("max_links_per_page", "max_candidates", "max_candidates_per_source", "max_parents_per_source")),
    ("common_crawl.collection", lambda v: isinstance(v, str) and bool(re.fullmatch(r"CC-MAIN-\d{4}-(0[1-9]|[1-4]\d|5[0-3])", v)), "CC-MAIN-YYYY-WW"),
    ("diagnostics.sample_cap", _count(0), "an integer of at least 0"),
    ("diagnostics.retain_runs", _count(1), "a positive integer"),
    ("quality.min_score", _SHARE, "from 0 to 1"),
    ("language.min_confidence", _SHARE, "from 0 to 1"),
    ("quality.noise_patterns", _each(lambda p: isinstance(p, str) and _regex(p)), "regular expressions"),
    ("policy.profile", lambda v: v in PROFILES, "one of " + ", ".join(PROFILES)),
    ("sentence.min_tokens", _count(1), "a positive integer"),
    ("sentence.max_tokens", _count(1), "a positive integer"),
]


def _broken(tree: dict, rules: list[Rule]) -> list[str]:
    return [f"{path}: {at(tree, path)!r} isn't {what}" for path, good, what in rules if at(tree, path) is not None and not good(at(tree, path))]


def source_violations(source: dict) -> list[str]:
    """Every rule that a source's configuration breaks."""
    out = [f"{k}: a text is required" for k in ("id", "name", "domain") if not _text(source.get(k))]
    host = source.get("domain")
    if _text(host) and ("/" in host or ":" in host):
        out.append(f"domain: {host!r} isn't a bare host name")
    out += _broken(source, SOURCE_RULES)
    if out:
        return out
    start, end = at(source, "archive.start_date"), at(source, "archive.end_date")
    if start and end and str(start) > str(end):
        out.append("archive: start_date is after end_date")
    _, policy = resolve_policy(source)
    if policy.min_tokens > policy.max_tokens:
        out.append("min_tokens is more than max_tokens")
    patterns = at(source, "common_crawl.url_patterns") or []
    if at(source, "common_crawl.enabled") and not patterns:
        out.append("common_crawl.url_patterns: an enabled index needs a pattern")
    strip = lambda h: str(h).lower().split(":")[0].removeprefix("www.")
    hosts = source.get("allowed_hosts") or []
    known = {strip(h) for h in [host, *([hosts] if isinstance(hosts, str) else hosts)]}
    for p in patterns:
        m = re.fullmatch(r"https?://([^/?#]+)([^?#;]*)", p.strip())
        if not m or strip(m[1]) not in known:
            out.append(f"common_crawl.url_patterns: {p!r} isn't a plain URL pattern on the source's hosts")
        elif source.get("shared_domain") and not m[2].strip("/*"):
            out.append(f"common_crawl.url_patterns: {p!r} takes all of a shared host")
    return out


def run_violations(config: dict) -> list[str]:
    """Every rule that a run's configuration breaks."""
    out = _broken(config, RUN_RULES)
    low, high = at(config, "sentence.min_tokens"), at(config, "sentence.max_tokens")
    if not out and low and high and low > high:
        out.append("sentence: min_tokens is more than max_tokens")
    return out


def checked(sources: Iterable[dict], config: dict | None = None) -> list[dict]:
    """The sources, if they and the run's configuration break no rule and their ids differ."""
    sources = list(sources)
    wrong = [f"{s.get('id')}: {v}" for s in sources for v in source_violations(s)] + run_violations(config or {})
    ids = [s.get("id") for s in sources]
    wrong += [f"{i}: given twice" for i in sorted({str(i) for i in ids if ids.count(i) > 1})]
    if wrong:
        raise ConfigError("\n".join(wrong))
    return sources


def load(path: str) -> dict:
    """A configuration file: JSON, or YAML where a reader for it is installed."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise ConfigError("reading YAML needs the yaml package; give JSON") from e
    return yaml.safe_load(text)


def scope_of(source: dict) -> Source:
    """The scope of a source's configuration."""
    many = lambda k: tuple([source[k]] if isinstance(source.get(k), str) else source.get(k) or ())
    return Source(source["id"], source["domain"], source.get("url_prefix") or "", many("article_path_patterns"), many("landing_paths"), many("sibling_prefixes"), source.get("enabled", True), resolve_policy(source)[0])


def sources_table(spark: SparkSession, sources: Iterable[dict], config: dict | None = None) -> DataFrame:
    """A row for each source: its scope, selectors, priority and resolved policy."""
    rows = []
    for s in checked(sources, config):
        scope, (_, policy) = scope_of(s), resolve_policy(s, config)
        rows.append((scope.id, s["name"], scope.domain, scope.prefix, list(scope.patterns), list(scope.landing), list(scope.siblings), scope.enabled, at(s, "extraction.content_selector"), at(s, "extraction.date_selector"), at(s, "link_discovery.article_priority") or 100, scope.policy, tuple(list(v) if isinstance(v, tuple) else v for v in asdict(policy).values())))
    kinds = "min_tokens int, max_tokens int, include_quotes boolean, include_headlines boolean, accepted_languages array<string>, min_confidence double, allow_mixed boolean, classify_mixed boolean, min_quality_score double"
    return spark.createDataFrame(rows, f"source_id string, name string, domain string, prefix string, patterns array<string>, landing array<string>, siblings array<string>, enabled boolean, body_selector string, date_selector string, priority int, profile string, policy struct<{kinds}>")
