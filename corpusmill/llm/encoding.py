"""Exact tokenizer front ends for whole texts.

A byte-level BPE never merges across the pieces its splitting pattern yields, so the ids of a text are
the ids of its pieces in a row. `PieceEncoder` therefore asks the tokenizers library only for pieces it
hasn't met, and keeps the answers in a bounded memory. It uses the pieces only where that is provably
the library's own result: a known file layout, characters whose classes and case all Unicode versions
agree on, and no special string inside the text. Every other text goes to the library whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import struct
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa

#: Characters that both splitting patterns below classify as the library does.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-įı-ſ]*").fullmatch
_LETTER = r"A-Za-zªµºÀ-ÖØ-öø-ſ"
_NUMBER = r"0-9²³¹¼-¾"
_ELISIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_SPACED = re.compile(rf"{_ELISIONS}| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+").findall
_BARE = re.compile(rf"{_ELISIONS}|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+").findall


def _byte_chars() -> dict[int, int]:
    """Byte-level BPE writes printable bytes as themselves and the others, in order, as U+0100 and up."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()


def file_digest(path: str) -> str:
    """The tokenizer's version: SHA-256 of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _layout(spec: dict) -> str:
    """'spaced' or 'bare' for the two layouts whose pieces are known, '' for any other."""
    model = spec["model"]
    if model.get("type", "BPE") != "BPE" or model.get("dropout") or model.get("ignore_merges") or spec.get("truncation") or spec.get("padding"):
        return ""
    if any(a.get("normalized") or a.get("lstrip") or a.get("rstrip") or a.get("single_word") for a in spec["added_tokens"]):
        return ""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "spaced"
    steps = [x.get("type") for x in (norm or {}).get("normalizers", [])]
    inner = pre.get("pretokenizers", [])
    if steps == ["NFC", "Replace", "Lowercase"] and len(inner) == 2 and inner[0].get("pattern", {}).get("Regex") == rf"{_ELISIONS}|[\p{{L}}]+|[\p{{N}}]|[^\s\p{{L}}\p{{N}}]+":
        return "bare"
    return ""


class PieceEncoder:
    """Ids (as little-endian uint32 bytes) or id counts of texts, equal to the library's."""

    def __init__(self, path: str, keep: int = 200_000):
        self.path, self.keep, self.memory = path, keep, {}
        self.pieces = None
        if path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            self.ask = lambda texts: processor.encode(texts, num_threads=1)
            return
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        batch = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        self.ask = lambda texts: [x.ids for x in batch(texts, add_special_tokens=False)]
        self.lower = _layout(spec) == "bare"
        self.pieces = {"spaced": _SPACED, "bare": _BARE}.get(_layout(spec))
        self.special = [a["content"] for a in spec["added_tokens"]]
        self.model = tokenizer.model
        self.bare = self.lower

    def _split(self, text: str) -> list[str] | None:
        if self.pieces is None or not _PLAIN(text) or any(s in text for s in self.special):
            return None
        return self.pieces(text.lower() if self.lower else text)

    def _learn(self, pieces: Iterable[str], form) -> None:
        new = list(set(pieces).difference(self.memory))
        if new:
            if len(self.memory) + len(new) > self.keep:
                self.memory.clear()
                new = list(set(pieces))
            self.memory.update(zip(new, map(form, map(self._piece, new)), strict=True))

    def _piece(self, piece: str) -> list[int]:
        """The ids of one piece, from the model alone: byte-level text needs no other step."""
        if not piece.isascii() or not piece.isprintable() or " " in piece:
            piece = piece.encode().decode("latin-1").translate(_BYTE_CHARS)
        return [t.id for t in self.model.tokenize(piece)]

    def _each(self, text: str, form, join):
        pieces = self._split(text)
        if pieces is None:
            return form(self.ask([text])[0])
        self._learn(pieces, form)
        return join(map(self.memory.__getitem__, pieces))

    def count(self, text: str) -> int:
        return self._each(text, len, sum)

    def ids(self, text: str) -> bytes:
        return self._each(text, _packed, b"".join)


class BulkEncoder(PieceEncoder):
    """Ids of many texts at once.

    For the bare layout, texts are cut into pieces by array operations. Pieces are told apart by a 64-bit
    polynomial hash over their characters; the ids of up to `keep` pieces lie in one array, where each distinct
    piece of a slice is looked up once: by its hash in a sorted array, or among the last ones learnt.
    """

    def __init__(self, path: str, keep: int = 600_000, recent: int = 1 << 15):
        super().__init__(path, keep)
        self.most_recent = recent
        self._forget()

    def _forget(self) -> None:
        self.known, self.at = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.recent: dict[int, int] = {}
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int32)
        self.store = np.empty(0, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32) and how many each text has."""
        joined = "\n".join(texts)
        if self.pieces is not None and self.bare and _PLAIN(joined) and not any(s in joined for s in self.special):
            return self._bulk(joined, texts)
        plain = [self.pieces is not None and self.bare and bool(_PLAIN(t)) and not any(s in t for s in self.special) for t in texts]
        good = [t for t, ok in zip(texts, plain, strict=True) if ok]
        ids, counts = self._bulk("\n".join(good), good)
        parts, sizes, at, k = [np.empty(0, np.uint32)], [], 0, 0
        for t, ok in zip(texts, plain, strict=True):
            if ok:
                parts.append(ids[at : at + counts[k]])
                at, k = at + counts[k], k + 1
            else:
                parts.append(np.frombuffer(self.ids(t), "<u4"))
            sizes.append(len(parts[-1]))
        return np.concatenate(parts), np.array(sizes, np.int64)

    def _places(self, hashes: np.ndarray, lowered: str, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where in start and size each piece is."""
        table = pa.array(hashes).dictionary_encode()
        which, distinct = table.indices.to_numpy(), table.dictionary.to_numpy()
        if len(self.start) + len(distinct) > self.keep:
            self._forget()
        got = np.full(len(distinct), -1, np.int64)
        if len(self.known):
            near = np.minimum(np.searchsorted(self.known, distinct), len(self.known) - 1)
            hit = self.known[near] == distinct
            got[hit] = self.at[near[hit]]
        rest = np.flatnonzero(got < 0)
        keys = distinct[rest].tolist()
        got[rest] = [self.recent.get(k, -1) for k in keys]
        new = np.flatnonzero(got[rest] < 0)
        if len(new):
            first = np.empty(len(distinct), np.int64)
            first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
            first = first[rest[new]]
            ids = [self._piece(lowered[a:b]) for a, b in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
            size = np.fromiter(map(len, ids), np.int32, len(ids))
            places = np.arange(len(self.start), len(self.start) + len(new))
            self.start = np.concatenate((self.start, len(self.store) + np.cumsum(size, dtype=np.int64) - size))
            self.size = np.concatenate((self.size, size))
            self.store = np.concatenate((self.store, np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))))
            got[rest[new]] = places
            self.recent.update(zip((keys[i] for i in new.tolist()), places.tolist(), strict=True))
            if len(self.recent) > self.most_recent:
                known = np.concatenate((self.known, np.fromiter(self.recent, np.uint64, len(self.recent))))
                at = np.concatenate((self.at, np.fromiter(self.recent.values(), np.int32, len(self.recent))))
                order = np.argsort(known)
                self.known, self.at, self.recent = known[order], at[order], {}
        return got[which]

    def _bulk(self, joined: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        lowered = (joined + "\n\n\n").lower()
        chars = np.frombuffer(lowered.encode("utf-32-le"), np.uint32)
        kind = _KIND[chars]
        starts = np.empty(len(kind), bool)
        starts[0] = True
        np.not_equal(kind[1:], kind[:-1], out=starts[1:])
        starts |= kind == 2
        starts &= kind > 0
        quotes = np.flatnonzero((chars == ord("'")) & starts)
        if len(quotes):
            one, two = chars[quotes + 1], chars[quotes + 2]
            short = np.isin(one, _ONE)
            long = ((one == ord("l")) & (two == ord("l"))) | (np.isin(one, _TWO) & (two == ord("e")))
            for at, size in ((quotes[short], 2), (quotes[long & ~short], 3)):
                for i in range(1, size):
                    starts[at + i] = False
                starts[at + size] = kind[at + size] > 0
        begin = np.flatnonzero(starts)
        if not len(begin):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        # A piece ends where the next starts or a space follows.
        cuts = np.flatnonzero(starts | (kind == 0))
        end = cuts[np.flatnonzero(starts[cuts]) + 1]
        power, inverse = _powers(len(chars))
        total = np.empty(len(chars) + 1, np.uint64)
        total[0] = 0
        terms = _VALUE[chars]
        terms *= power[: len(chars)]
        np.cumsum(terms, out=total[1:])
        del terms, chars, kind, starts, cuts
        place = self._places((total[end] - total[begin]) * inverse[begin], lowered, begin, end)
        del total
        each = self.size[place].astype(np.int64)
        after = np.cumsum(each)
        index = np.repeat(self.start[place] - (after - each), each)
        index += np.arange(after[-1])
        upto = np.concatenate(([0], after))[np.searchsorted(begin, ends)]
        return self.store[index], np.diff(upto, prepend=0)


@functools.lru_cache(maxsize=1)
def bulk_encoder(path: str) -> BulkEncoder:
    """The worker's own, which its later tasks use again."""
    return BulkEncoder(path)


def _kinds() -> np.ndarray:
    """By character: 0 space, 1 letter, 2 number, 3 other."""
    letter, number = re.compile(f"[{_LETTER}]").match, re.compile(f"[{_NUMBER}]").match
    return np.array([0 if chr(c) in "\t\n\r " else 1 if letter(chr(c)) else 2 if number(chr(c)) else 3 for c in range(0x180)], np.uint8)


_KIND = _kinds()
_VALUE = np.random.default_rng(8).integers(1, 1 << 63, 0x180, dtype=np.uint64)
_ONE = np.array([ord(c) for c in "stmd"], np.uint32)
_TWO = np.array([ord(c) for c in "rv"], np.uint32)
_BASE = 0x9E3779B97F4A7C15
_TABLES: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if len(_TABLES[0]) < n:
        for i, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(1 << n.bit_length(), b, np.uint64)
            row[0] = 1
            _TABLES[i] = np.cumprod(row)
    return _TABLES


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)
