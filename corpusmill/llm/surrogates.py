"""PII surrogates: detected entities receive keyed, type-consistent replacements.

An entity is a type and a normal form (a phone number's last nine digits, say), so that differently written
mentions of one entity meet. Its surrogate comes from a keyed hash: it has the same type, length,
character classes, separators, country prefix or first digits, valid check digits where the original's
are valid, for person names the same title, gender, script and case, and for secrets the same issuer's
prefix. Equal entities get equal surrogates everywhere, which keeps coreference.

Distinctness is checked over the whole corpus: the distinct entities propose surrogates in rounds; where
two propose the same, or one proposes what is itself an entity of the corpus, all but one go to their
next attempt. Later attempts may be longer than the original, so that mail addresses, names and secrets don't
run out however many of one pattern there are. Only entities with a later attempt (the exceptions) have to be remembered. They are few;
up to `most_exceptions` of them travel as a broadcast, beyond it they are joined to their documents.
Texts are read twice and, unless there are that many exceptions, never shuffled.

Defined cases: null texts stay null and have no entities; overlapping mentions count once, the earlier and
longer first; repeated rows give repeated rows; a null doc_id is kept; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_slices, written

#: Given names by script and gender, and titles that tell the gender.
NAMES = {
    ("latin", "f"): "Anna Maria Laura Julia Sofia Clara Elena Emma Lucia Paula Sarah Nora Alice Eva Ines Carla".split(),
    ("latin", "m"): "David Martin Thomas Paul Lucas Daniel Marco Peter Simon Oscar Victor Julian Hugo Felix Adam Leo".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Ирина Вера Дарья Нина".split(),
    ("cyrillic", "m"): "Иван Пётр Павел Сергей Андрей Олег Игорь Борис".split(),
}
TITLES = {"Mr": "m", "Herr": "m", "Sr": "m", "Monsieur": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Sra": "f", "Srta": "f", "Mme": "f", "Mlle": "f", "Madame": "f", "Dr": "", "Prof": "", "Г-н": "m", "Г-жа": "f"}
SYLLABLES = {"latin": "ba be bo da de do fa fe ga go ka ke la le lo ma me mo na ne no ra re ri ro sa se ta te to va ve".split(), "cyrillic": "ба бе бо да де до га го ка ке ла ле ма ме на не ра ре са се та те".split()}
_GENDER = {n.lower(): g for (_, g), names in NAMES.items() for n in names}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: How secrets begin that carry their issuer's prefix. A secret's own part is its pattern's last group.
_SECRETS = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)([A-Z0-9]{16})(?![A-Za-z0-9])|(?:gh[opsur]_|github_pat_|glpat-)([A-Za-z0-9_]{20,})"
    r"|[spr]k_(?:live|test)_([A-Za-z0-9]{16,})|xox[abeoprs]-([A-Za-z0-9-]{10,})|AIza([A-Za-z0-9_-]{35})|sk-([A-Za-z0-9_-]{20,})"
    r"|eyJ([A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*))"
)
_ASSIGNED = re.compile(r"(?i)(?:pass(?:word|wd|phrase)|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|credentials?)[\"']?[ \t]*(?:=>|:=|[:=])[ \t]*(?:\"([^\"\s]{6,})\"|'([^'\s]{6,})'|([^\s\"',;<>]{6,}))")
_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(.*?)-----END [A-Z ]*PRIVATE KEY-----", re.DOTALL)
_HINTS = ("AKIA", "ASIA", "gh", "glpat-", "k_", "xox", "AIza", "sk-", "eyJ")
_IPV6 = re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f:]*[0-9A-Fa-f])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
_DOMAIN = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])")
#: Groups of a phone number and what stands between them: blanks, dots, slashes and hyphens, or a bracket alone.
_GROUP, _GAP = r"(?:\(\d{1,6}\)|\d{1,15})", r"[ \u00a0\u202f.\-\u2010-\u2013/]"
_NUMBERS = re.compile(
    r"(?:(?<![\w.])|(?<=\w[=:]))(?:(?P<ip>\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?!\.?\w)"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})(?![-\w])"
    r"|(?P<card>\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}|\d{4}[ -]?\d{6}[ -]?\d{5})(?![-\w])"
    rf"|(?P<phone>\+?{_GROUP}(?:(?:{_GAP}|(?=\()|(?<=\))){_GROUP})*)(?![-\w]))"
)
_DIGIT = re.compile(r"\d").search
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
#: Given names that mark a person without a title, besides those of NAMES.
GIVEN = {
    "m": "John James Robert Michael William Richard Joseph Charles Christopher Matthew Anthony Andrew Joshua Kevin Brian George Edward Jean Pierre Jacques François Michel Philippe Nicolas Hans Klaus Jürgen Wolfgang Stefan Andreas Markus Uwe Juan José Carlos Luis Miguel Javier Antonio Manuel Pedro Pablo".split(),
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Karen Nancy Margaret Emily Marie Isabelle Nathalie Sylvie Camille Sabine Petra Monika Ursula Claudia Katrin Heike Carmen Ana Isabel Pilar Cristina Marta Rosa".split(),
}
_GENDER |= {n.lower(): g for g, names in GIVEN.items() for n in names}
_GIVEN = sorted({n for names in (*NAMES.values(), *GIVEN.values()) for n in names}, key=lambda n: (-len(n), n))
_WORD = r"[^\W\d_][\w'’-]*"
#: Further words of a name: particles before a capital, initials, capitalised words.
_MORE = rf"(?:[ \t](?:(?:de|del|la|las|los|da|do|dos|di|van|von|der|den|zu|y|e|le|du|bin|al)[ \t])*(?:[^\W\d_a-z]\.(?=[ \t])|[^\W\d_a-z][\w'’-]*))"
_PERSON = re.compile(r"\b(" + "|".join(sorted(TITLES, key=len, reverse=True)) + rf")(\.?\s)((?:[^\W\d_a-z]\.[ \t])*{_WORD}{_MORE}*)")
_NAMED = re.compile(rf"\b(?:{'|'.join(_GIVEN)}){_MORE}+")
_PARTS = re.compile(r"\S+")


def _phones(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Where the phone numbers of a run of groups are: as many digits as possible in as few numbers of 9 to 15 digits."""
    groups = [(m.start(), m.end(), sum(map(str.isdigit, m[0]))) for m in re.finditer(_GROUP, text[start:end])]
    best: list[tuple] = [(0, 0, None)]
    for i in range(1, len(groups) + 1):
        # Either the last group belongs to no number, or a number of the last groups ends here.
        choice, digits, widest = (best[i - 1][0] + groups[i - 1][2], best[i - 1][1], None), 0, 0
        for j in range(i - 1, -1, -1):
            digits += groups[j][2]
            widest = max(widest, groups[j][2])
            if digits > 15:
                break
            marked = (j == 0 and text[start] == "+") or text[start + groups[j][0]] == "("
            fraction = i - j == 2 and text[start + groups[j][1] : start + groups[i - 1][0]] == "."
            if digits >= 9 and (marked or (widest > 2 and not fraction)):
                choice = min(choice, (best[j][0], best[j][1] + 1, j), key=lambda c: c[:2])
        best.append(choice)
    out, i = [], len(groups)
    while i:
        j = best[i][2]
        if j is not None:
            out.append((start + groups[j][0] if j else start, start + groups[i - 1][1]))
        i = i - 1 if j is None else j
    return out[::-1]


def _name(text: str, start: int, end: int) -> tuple[int, list[str]]:
    """End and words of the name that starts at start; a word that isn't capitalised, other than a particle, ends it."""
    words, kept, upto = [], 0, start
    for m in _PARTS.finditer(text, start, end):
        word = m[0][:-2] if m[0].endswith(("'s", "’s")) else m[0]
        if words and word.rstrip(".") in TITLES:
            break
        words.append(word)
        if word[0].isupper():
            kept, upto = len(words), m.start() + len(word)
        elif len(words) == 1 or not word.isascii() or word != m[0]:
            break
        if word != m[0]:
            break
    return upto, words[:kept]


def _persons(text: str) -> list[tuple[int, int, str, str]]:
    """Names after titles, known given names with what follows, and untitled mentions of both in the same text."""
    out, full = [], {}
    titled = [(m.start(3), m.end(3), TITLES[m[1]]) for m in _PERSON.finditer(text)] if any(t in text for t in TITLES) else []
    for start, end, gender in [*titled, *((m.start(), m.end(), "") for m in _NAMED.finditer(text))]:
        end, name = _name(text, start, end)
        if name and not (len(out) >= len(titled) and len(name) < 2):
            out.append((start, end, gender or _GENDER.get(name[0].lower(), ""), name))
    if not out:
        return out
    # A person named in full gives the normal form for later mentions by surname, or in full without the title.
    for _, _, gender, name in sorted(out, key=lambda e: (-len(e[3]), not e[2])):
        whole, last = " ".join(name), name[-1]
        full.setdefault(whole.lower(), []).append(f"{gender}|{whole.lower()}")
        if len(name) > 1:
            full.setdefault(last.lower(), []).append(f"{gender}|{whole.lower()}")

    def normal(words: str, gender: str) -> str:
        own = f"{gender}|{words}"
        return next((n for n in full.get(words, ()) if not gender or n[: n.index("|")] in ("", gender)), own)

    found = [(start, end, "person", normal(" ".join(name).lower(), gender)) for start, end, gender, name in out]
    wanted = {w for _, _, _, name in out for w in (" ".join(name), name[-1]) if len(w) > 2}
    again = re.compile(r"(?<!\w)(?:" + "|".join(re.escape(w) for w in sorted(wanted | {w.upper() for w in wanted}, key=lambda w: (-len(w), w))) + r")(?!\w)")
    return found + [(m.start(), m.end(), "person", normal(m[0].lower(), "")) for m in again.finditer(text)]


def _luhn(digits: str) -> int:
    """The check sum modulo 10: 0 for a valid number."""
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, type and normal form of the entities of a text, in order, not overlapping."""
    out = []
    at = text.find("@")
    while at >= 0:
        start, domain = at, _DOMAIN.match(text, at + 1)
        while domain and start and text[start - 1] in _LOCAL:
            start -= 1
        start += len(text[start:at]) - len(text[start:at].lstrip("."))
        if domain and start < at:
            out.append((start, domain.end(), "email", text[start : domain.end()].lower()))
        at = text.find("@", at + 1)
    digit = _DIGIT(text)
    for m in _NUMBERS.finditer(text, max(0, digit.start() - 6)) if digit else ():
        kind, value = m.lastgroup, m[0]
        digits = _digits(value)
        if kind == "ip" and not all(int(x) < 256 for x in value.split(".")):
            continue
        if kind == "card" and not 13 <= len(digits) <= 19:
            continue
        if kind == "phone":
            out += [(i, j, kind, _digits(text[i:j])[-9:]) for i, j in _phones(text, m.start(), m.end())]
            continue
        out.append((m.start(), m.end(), kind, value if kind == "ip" else digits))
    for m in _IBAN.finditer(text) if digit else ():
        flat = m[0].replace(" ", "")
        if 15 <= len(flat) <= 34 and _mod97(flat) == 1:
            out.append((m.start(), m.end(), "iban", flat))
    for m in _IPV6.finditer(text) if "::" in text or text.count(":") > 6 else ():
        try:
            out.append((m.start(), m.end(), "ipv6", ipaddress.IPv6Address(m[0]).exploded))
        except ValueError:
            continue
    out += _secrets(text)
    out += _persons(text)
    out.sort(key=lambda e: (e[0], -e[1]))
    kept, upto = [], -1
    for e in out:
        if e[0] >= upto:
            kept.append(e)
            upto = e[1]
    return kept


def _secrets(text: str) -> list[tuple[int, int, str, str]]:
    """Keys with an issuer's prefix, what a secret's name is set to, and the bodies of private keys."""
    out = []
    patterns = [_SECRETS] * any(h in text for h in _HINTS) + [_ASSIGNED] * any(c in text for c in "=:") + [_BLOCK] * ("PRIVATE KEY-----" in text)
    for pattern in patterns:
        for m in pattern.finditer(text):
            i = m.lastindex
            if i and m[i].strip() and any(map(str.isalnum, m[i])) and (pattern is not _ASSIGNED or any(map(str.isdigit, m[i]))):
                out.append((m.start(i), m.end(i), "secret", m[i]))
    return out


class Draw:
    """A keyed stream of choices."""

    def __init__(self, key: bytes, *names: object):
        self.n = int.from_bytes(hmac.digest(key, "\x1f".join(map(str, names)).encode("utf-8", "surrogatepass"), hashlib.sha512), "big")

    def below(self, most: int) -> int:
        self.n, x = divmod(self.n, most)
        return x

    def like(self, text: str) -> str:
        """The same classes of characters."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif c.isascii() and c.isalpha():
                out.append(chr((97 if c.islower() else 65) + self.below(26)))
            else:
                out.append(c)
            if self.n < 1 << 64:
                self.n = int.from_bytes(hashlib.sha512(str(self.n).encode()).digest(), "big")
        return "".join(out)


def surrogate(key: bytes, kind: str, normal: str, attempt: int = 0) -> str:
    """The normal form of an entity's replacement."""
    draw = Draw(key, kind, normal, attempt)
    if kind == "email":
        local, _, domain = normal.partition("@")
        *labels, top = domain.split(".")
        # The domain's own stream leaves out the attempt: people of one domain stay together.
        return f"{draw.like(local)}{draw.like('a' * (attempt // 4))}@{Draw(key, 'domain', domain).like('.'.join(labels))}.{top}"
    if kind == "secret":
        return draw.like(normal) + draw.like("a" * (attempt // 4))
    if kind == "ipv6":
        # Groups of zeros stay, at first, so that a short form stays as short.
        groups = normal.split(":")
        return ":".join(f"{1 + draw.below(16 ** len(g.lstrip('0')) - 1):04x}" if int(g, 16) or attempt > 4 + i else g for i, g in enumerate(groups)) if attempt <= 4 else ":".join(f"{draw.below(1 << 16):04x}" for _ in groups)
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "ssn":
        return f"{1 + draw.below(665):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "card":
        body = normal[:1] + draw.like(normal[1:-1])
        valid = -_luhn(body + "0") % 10
        return body + str(valid if _luhn(normal) == 0 else (valid + 1 + draw.below(9)) % 10)
    if kind == "phone":
        return draw.like(normal)
    if kind == "iban":
        body = draw.like(normal[4:])
        return f"{normal[:2]}{98 - _mod97(normal[:2] + '00' + body):02d}{body}"
    gender, _, name = normal.partition("|")
    script = "cyrillic" if re.search("[а-яё]", name) else "latin"
    words = name.split()
    family = "".join(SYLLABLES[script][draw.below(len(SYLLABLES[script]))] for _ in range(4 + attempt // 4))
    given = NAMES[script, gender or "fm"[draw.below(2)]]
    # The original's gender mark stays, so that surrogates and entities compare as equals.
    return f"{gender}|{' '.join([given[draw.below(len(given))].lower()] * (len(words) > 1) + [family])}"


def render(original: str, kind: str, normal: str) -> str:
    """A normal form written in the original's format."""
    if kind in ("ssn", "card", "phone"):
        # What a phone number has before its last nine digits (country, area) stays.
        lead = sum(map(str.isdigit, original)) - len(normal)
        digits = iter(_digits(original)[:lead] + normal)
        return "".join(next(digits) if c.isdigit() else c for c in original)
    if kind == "ipv6":
        short = original.lower() != ipaddress.IPv6Address(original).exploded
        text = ipaddress.IPv6Address(normal).compressed if short else normal
        return text.upper() if original.upper() == original else text
    if kind == "iban":
        chars = iter(normal)
        return "".join(next(chars) if c != " " else c for c in original)
    if kind == "person":
        name = normal.partition("|")[2]
        # A mention by surname shows the surname of the person's surrogate.
        name = name if len(original.split()) > 1 else name.split()[-1]
        return name.upper() if original.isupper() and len(original) > 1 else name.title()
    if kind == "email" and original.isupper():
        return normal.upper()
    return normal


_MENTION = "kind string, normal string"


def entities(docs: DataFrame) -> DataFrame:
    """The distinct entities of all documents: kind, normal."""

    def spot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            found = sorted({e[2:] for t in batch.column("text").to_pylist() for e in find(t)})
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["kind", "normal"])

    return docs.select("text").where(F.col("text").isNotNull()).mapInArrow(spot, _MENTION).distinct()


def exceptions(known: DataFrame, key: bytes, rounds: int = 60) -> DataFrame:
    """kind, normal and attempt of the entities whose first surrogate was taken; known: written, distinct."""

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [surrogate(key, r["kind"], r["normal"], r["attempt"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, "made"])

    schema = "kind string, normal string, attempt int, made string"
    names = known.select("kind", F.col("normal").alias("made"), F.lit(1).alias("_real"))
    order = Window.partitionBy("kind", "made").orderBy("attempt", F.xxhash64("normal"), "normal")
    table = known.withColumn("attempt", F.lit(0)).mapInArrow(propose, schema)
    for _ in range(rounds):
        # Settled surrogates come first in their group, whatever their attempt was: losers only move on.
        placed = table.join(names, ["kind", "made"], "left").withColumn("_place", F.row_number().over(order))
        loses = (F.col("_place") > 1) | F.col("_real").isNotNull()
        marked = written(placed.select("kind", "normal", "attempt", "made", loses.alias("loses")), "surrogates")
        if marked.where("loses").limit(1).count() == 0:
            break
        moved = marked.where("loses").select("kind", "normal", (F.col("attempt") + 1).alias("attempt")).mapInArrow(propose, schema)
        table = marked.where("NOT loses").drop("loses").unionByName(moved)
    else:
        raise RuntimeError("some type of entity leaves no room for distinct surrogates")
    return marked.where("attempt > 0").select("kind", "normal", "attempt")


def pseudonymize(docs: DataFrame, key: bytes, most_exceptions: int = 100_000) -> DataFrame:
    """doc_id, text with surrogates, n_entities and kinds of every document."""
    late = written(exceptions(written(entities(docs), "entities"), key), "exceptions")
    rows = docs.select("doc_id", "text")
    few = late.count() <= most_exceptions
    if few:
        attempts = {(r.kind, r.normal): r.attempt for r in late.collect()}
        shared = docs.sparkSession.sparkContext.broadcast(attempts)
        source = rows.withColumn("late", F.lit(None).cast("array<struct<kind string, normal string, attempt int>>"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast({})
        source = _with_exceptions(rows, late)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = shared.value
        for batch in text_slices(batches, "text"):
            texts, counts, kinds = [], [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("late").to_pylist(), strict=True):
                attempts = {(x["kind"], x["normal"]): x["attempt"] for x in own} if own else every
                found = find(text) if text else []
                parts, upto = [], 0
                for start, end, kind, normal in found:
                    parts += [text[upto:start], render(text[start:end], kind, surrogate(key, kind, normal, attempts.get((kind, normal), 0)))]
                    upto = end
                texts.append("".join(parts) + text[upto:] if found else text)
                counts.append(len(found))
                kinds.append(",".join(sorted({e[2] for e in found})))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(kinds, pa.string())], names=["doc_id", "text", "n_entities", "kinds"])

    return source.mapInArrow(replace, "doc_id bigint, text string, n_entities bigint, kinds string")


def _with_exceptions(rows: DataFrame, late: DataFrame) -> DataFrame:
    """Each document with the exceptions among its own entities, for more of them than may be broadcast."""

    def spot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            pairs = [(d, *e[2:]) for d, t in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist(), strict=True) for e in find(t)]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*pairs, strict=True)], names=["digest", "kind", "normal"])

    keyed = rows.withColumn("digest", F.sha2("text", 256))
    mentions = keyed.where(F.col("text").isNotNull()).select("digest", "text").mapInArrow(spot, "digest string, kind string, normal string").distinct()
    own = mentions.join(late, ["kind", "normal"]).groupBy("digest").agg(F.collect_list(F.struct("kind", "normal", "attempt")).alias("late"))
    return keyed.join(own, "digest", "left").select("doc_id", "text", "late")
