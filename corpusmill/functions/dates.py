"""Date texts in Python, for rules that have to know which of several candidates parses."""

from __future__ import annotations

from datetime import datetime, timezone
from email.utils import parsedate_to_datetime

#: The written forms that are tried after ISO and RFC 2822.
FORMS = (
    "%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y/%m/%d", "%B %d, %Y", "%b %d, %Y", "%d %B %Y", "%d %b %Y",
    "%B %d, %Y %I:%M %p", "%b %d, %Y %I:%M %p", "%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%dT%H:%M:%S",
)


def _tried(parse, text: str) -> datetime | None:
    try:
        return parse(text)
    except (TypeError, ValueError, IndexError):
        return None


def parse(text: str | None) -> datetime | None:
    """The date of a text, aware if the text names a zone; None where it's no date."""
    text = (text or "").strip()
    if not text:
        return None
    # Forms with AM or PM come before RFC 2822, which would read past them.
    forms = [(lambda t, form=form: datetime.strptime(t, form)) for form in sorted(FORMS, key=lambda f: "%p" not in f)]
    halves = sum("%p" in f for f in FORMS)
    attempts = [lambda t: datetime.fromisoformat(t.replace("Z", "+00:00")), *forms[:halves], parsedate_to_datetime, *forms[halves:]]
    return next((got for got in (_tried(a, text) for a in attempts) if got is not None), None)


def utc(value: datetime | None) -> datetime | None:
    """An aware date as naive UTC; a naive one as it is."""
    return value.astimezone(timezone.utc).replace(tzinfo=None) if value is not None and value.tzinfo else value
