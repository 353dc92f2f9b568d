"""Text columns: normal form, sentences, quality, hashes. All are native expressions."""

from __future__ import annotations

from unicodedata import is_normalized, normalize

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .status import let

# Abbreviations, noise patterns and thresholds of the segmentation and quality rules.
ABBREVIATIONS = (
    "dr mr ms mrs inc jr sr no etc vs prof gen rep sen atty hon gov sgt lt col capt eng arch gng bb kgg "
    "bal ulat pax php pct jan feb mar apr jun jul aug sept oct nov dec pnas a b c g"
).split()
TERMINAL_ABBREVIATIONS = "atty dr gng mr mrs ms prof sen rep gov sgt lt col capt eng arch".split()
NOISE = [
    r"^photo\b", r"^larawan\b", r"^credit\b", r"^abante\s+tnt\b", r"^read\s+more\b", r"^click\s+here\b",
    r"^mag-subscribe\b", r"^i-share\b", r"^basahin\s+din\b", r"^sundan\s+kami\b", r"^newsletter\b",
    r"^advertisement\b", r"^patalastas\b", r"all\s+rights\s+reserved", r"copyright\b", r"^[-–—•*]\s*",
]

_CLOSE = r"""["'”’»)\]}]*+"""
_END = rf"(?={_CLOSE}(?:$|\s|\p{{Lu}}))"


def _token(words: list[str]) -> str:
    return rf"(?<=(?<!\w)(?i:{'|'.join(words)})\.)"


#: A mark that ends a sentence, with its closing quotes, as one pattern. The first look-ahead turns most characters away.
BOUNDARY = (
    rf"(?=[.!?])(?U)(?:[!?]{_END}|(?:(?<!\d)\.|\.(?!\d))(?!\.)"
    rf"(?!{_token(TERMINAL_ABBREVIATIONS)}{_CLOSE}\s*+$)(?!{_token(ABBREVIATIONS)}{_CLOSE}\s*+\S)(?!(?<=(?<!\w)\w\.){_CLOSE}\s*+\p{{L}}){_END}){_CLOSE}"
)


#: A web address runs to the next white space; no full stop in it ends a sentence.
_ADDRESS = r"(?i:https?://|www\.)(?U:\S)*"
_STOP, _CUT = "\u0002", "\u0001"


@F.arrow_udf(StringType())
def nfc(c: pa.Array) -> pa.Array:
    """Composed characters (NFC)."""
    return pa.array([x if x is None or is_normalized("NFC", x) else normalize("NFC", x) for x in c.to_pylist()], pa.string())


def normalize_text(c: Column, compose: bool = False) -> Column:
    """Soft hyphens gone, space separators plain, runs of blanks (not line feeds) one; null is empty.

    Spark has no composing function, so unless compose, input is taken as NFC already; compose sends it through Arrow.
    """
    whole = F.coalesce(c, F.lit(""))
    bare = F.replace(nfc(whole) if compose else whole, F.lit("\u00ad"), F.lit(""))
    return F.trim(F.regexp_replace(bare, r"[\p{Zs}\t\r\f\x0B]{2,}|[\p{Zs}\t\r\f\x0B&&[^ ]]", " "), F.lit(" \t\n\r\f\x0b"))


def content_hash(c: Column) -> Column:
    """SHA-256 of the lower-cased, space-collapsed text."""
    # A run that is one blank already isn't replaced.
    return F.sha2(F.trim(F.regexp_replace(F.lower(c), r"(?U)(?: \s|[\s&&[^ ]])\s*", " ")), 256)


def token_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\S+"))


def paragraphs(c: Column) -> Column:
    """The non-blank lines of a text, stripped."""
    lines = F.split(F.replace(normalize_text(F.replace(c, F.lit("\r\n"), F.lit("\n"))), F.lit("\n "), F.lit("\n")), "\n")
    return F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != "")


def sentences(c: Column, allow_unterminated: bool = False) -> Column:
    """array<struct<text, paragraph_index>> of a text; an unterminated tail of a paragraph is dropped."""

    def split(p: Column, i: Column) -> Column:
        addresses = F.transform(F.regexp_extract_all(p, F.lit(f"({_ADDRESS})"), 1), lambda a: F.replace(a, F.lit("."), F.lit(_STOP)))
        pieces = F.zip_with(F.split(p, _ADDRESS), addresses, lambda x, a: F.concat(x, F.coalesce(a, F.lit(""))))
        held = F.when(p.contains("://") | F.lower(p).contains("www."), F.array_join(pieces, "")).otherwise(p)
        parts = F.split(F.regexp_replace(held, BOUNDARY, f"$0{_CUT}"), _CUT)
        if not allow_unterminated:
            parts = let(parts, lambda x: F.slice(x, 1, F.size(x) - 1))
        return F.transform(F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != ""), lambda s: F.struct(F.replace(s, F.lit(_STOP), F.lit(".")).alias("text"), i.alias("paragraph_index")))

    return F.flatten(F.transform(paragraphs(c), split))


def is_quote(c: Column) -> Column:
    return c.rlike("""^["“‘']|["”’»']$""")


def quality_reason(text: Column, *, low: int = 5, high: int = 80, quotes: bool = False, headlines: bool = False, quote: Column | None = None, headline: Column | None = None, least_score: float = 0.0, noise_patterns: list[str] | None = None, tokens: Column | None = None, lower: Column | None = None) -> Column:
    """The first reason that rejects a normalised sentence, or 'accepted'. Limits may be values or columns.

    tokens, lower: the sentence's token count and lower-case form, where they are columns already.
    """
    quotes, headlines = (x if isinstance(x, Column) else F.lit(x) for x in (quotes, headlines))
    tokens, lower = token_count(text) if tokens is None else tokens, F.lower(text) if lower is None else lower
    alnum = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]+", "")) / F.greatest(F.lit(1), F.length(text))
    if noise_patterns is None:  # those that may stand anywhere are looked for where a word of theirs is
        starts = "|".join(p[1:] for p in NOISE if p.startswith("^"))
        inside = "|".join(p for p in NOISE if not p.startswith("^"))
        noise = lower.rlike(f"(?U)^(?:{starts})") | ((lower.contains("rights") | lower.contains("copyright")) & lower.rlike(f"(?U){inside}"))
    else:
        noise = lower.rlike("(?U)" + "|".join(noise_patterns or ["(?!)"]))
    address = lower.contains("://") | lower.contains("www.") | text.contains("@")
    rules = [
        (text == "", "empty"),
        ((headline if headline is not None else F.lit(False)) & ~headlines, "headline_excluded"),
        ((quote if quote is not None else F.lit(False)) & ~quotes, "quote_excluded"),
        (tokens < low, "too_short"),
        (tokens > high, "too_long"),
        (text.contains("<") | text.contains(">") | text.contains("{") | text.contains("}") | lower.contains("javascript:"), "markup"),
        (address & text.rlike(r"(?i)https?://|www\.|[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}"), "url_or_email"),
        (noise, "boilerplate"),
        (text.rlike(r"[\p{Cc}\p{Cf}&&[^\n\t]]"), "control_character"),
        (alnum < 0.6, "symbol_noise"),
        (~(text.endswith(".") | text.endswith("?") | text.endswith("!") | text.rlike("""[.!?]["'’”»)]*$""")), "unterminated"),
        ((F.lit(1.0) < least_score), "low_quality_score"),
    ]
    out = F.lit("accepted")
    for when, reason in reversed(rules):
        out = F.when(when, reason).otherwise(out)
    return out


def normal_tokens(c: Column) -> Column:
    """token_count of a text in normal form, which has no white space at its ends."""
    return F.when(c == "", 0).otherwise(F.size(F.split(c, r"\s+")))


def words(c: Column) -> Column:
    """The lower-cased words of a text, in order."""
    return F.filter(F.split(F.lower(c), r"(?U)\W+"), lambda w: w != "")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def sha256(c: Column) -> Column:
    """SHA-256 of a URL, of raw bytes, or of a configuration's JSON, as an id."""
    return F.sha2(c, 256)


def lowered(c: Column) -> Column:
    """The stored lower-case form of a sentence."""
    return F.lower(c)
