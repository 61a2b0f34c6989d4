"""Secret scan: fixed patterns plus sliding-window Shannon entropy per character class, with an allow-list.

A candidate is a run of token characters. For each character class the scan slides windows over the candidate's runs of that class and
keeps the entropy by incremental counts: one count goes up and one down at each step. Windows over their threshold are merged into
spans. The allow-list is asked about the parts of a candidate between ``/``, ``=`` and ``+``: a span that lies in allowed parts alone is
suppressed, and allowed parts at its ends are cut off, so that a key in a path or behind a name is still found.

Null text counts as empty: no spans. An empty table gives no rows. Repeated rows give repeated results, and rows are judged one by one,
so there are no ties. Texts are scanned whole, at any length. Only doc_id and text are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class EntropyClass:
    """Characters, and pairs of a window's width and the least entropy in bits of a window that counts."""

    name: str
    chars: str
    windows: tuple[tuple[int, float], ...]


#: Random hex digits come to about 3.3 bits in a window of 24 and 3.0 in one of 16; random letters and digits to 4.2 and 3.8.
CLASSES = (
    EntropyClass("hex", r"[0-9a-fA-F]", ((24, 3.0), (16, 2.7))),
    EntropyClass("alnum", r"[A-Za-z0-9]", ((24, 3.7), (16, 3.5))),
    EntropyClass("base64", r"[A-Za-z0-9+/=_-]", ((24, 3.8), (16, 3.6))),
)

#: Parts of candidates that are not secrets. Each pattern matches a text in one way at most, or in time linear in its length.
ALLOW = (
    r"[0-9_-]*",
    r"[a-z]+|[A-Z]+|[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*[A-Z]*",  # words, also run together by capitals
    r"[A-Za-z]+[0-9]{1,4}",
    r"(?:(?:[A-Za-z]+[0-9]{0,4})?[-_])++(?:[A-Za-z]*[0-9]{0,4}|[0-9]{5,20})",  # word lists, with a number at their end
    r"(.{1,8}?)\1+.{0,8}",  # one unit again and again
    r"(?i)(?:0123456789|1234567890|abcdefghijklmnopqrstuvwxyz|abcdefghij|abcdef|qwertyuiop)+[a-z0-9]{0,4}",  # counted sequences
    r"(?i)[^_-]*(?:example|sample|placeholder|changeme|your[_-]?(?:key|token|secret))[^_-]*",  # stated examples
)
PART = re.compile(r"[^/=+]+")
#: The words of a part that state an example: they are left out, and the rest of the part is judged by itself.
EXAMPLE = re.compile(r"(?:^|(?<=[_-]))" + ALLOW[-1].removeprefix("(?i)") + r"(?:[_-]|$)", re.I)


@dataclass(frozen=True)
class SecretScanner:
    classes: tuple[EntropyClass, ...] = CLASSES
    allow: tuple[str, ...] = ALLOW
    _made: dict = field(default_factory=dict, compare=False)

    def _parts(self):
        if not self._made:
            least = min(width for c in self.classes for width, _ in c.windows)
            self._made["candidates"] = re.compile(r"[A-Za-z0-9+/=_-]{%d,}" % least)
            self._made["others"] = [(c, re.compile(f"(?!{c.chars}).", re.S)) for c in self.classes]
            self._made["allow"] = [re.compile(p, re.S) for p in self.allow]
        return self._made

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind's place, end) of the fixed patterns, leftmost and non-overlapping per kind."""
        out = []
        low = text.lower()
        if any(w in low for w in ASSIGN_WORDS):
            out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        return out + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]

    def is_allowed(self, part: str) -> bool:
        return any(p.fullmatch(part) for p in self._parts()["allow"])

    def entropy(self, text: str) -> list[tuple[int, int, int]]:
        made, out = self._parts(), []
        for m in made["candidates"].finditer(text):
            word = m[0]
            suspect = [(a, b) for a, b in self.parts(word) if not self.is_allowed(word[a:b])]
            if not suspect:
                continue
            hot = [span for c, other in made["others"] for width, bits in c.windows for span in windows_over(word, other, width, bits)]
            starts, ends = [a for a, _ in suspect], [b for _, b in suspect]
            for a, b in merged(hot):
                first, last = bisect_right(ends, a), bisect_left(starts, b) - 1
                if first <= last:
                    out.append((m.start() + max(a, starts[first]), 3, m.start() + min(b, ends[last])))
        return out

    @staticmethod
    def parts(word: str) -> list[tuple[int, int]]:
        """The parts of a candidate that are judged, in order: between slashes and the like, and without words that state an example."""
        out = []
        for p in PART.finditer(word):
            at = p.start()
            for e in EXAMPLE.finditer(p[0]):
                if p.start() + e.start() > at:
                    out.append((at, p.start() + e.start()))
                at = p.start() + e.end()
            if p.end() > at:
                out.append((at, p.end()))
        return out

    def __call__(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) of all spans by start, then kind; an entropy span inside a fixed one adds nothing and is left out."""
        text = text or ""
        base = self.base(text)
        more = [(a, k, b) for a, k, b in self.entropy(text) if not any(x <= a and b <= y for x, _, y in base)]
        return [(KINDS[k], a, b) for a, k, b in sorted(base + more)]


#: Starts of windows that are gone through at once.
STRETCH = 1 << 15


def _hot_starts(codes: np.ndarray, width: int, bits: float) -> np.ndarray:
    """Where windows of at least ``bits`` begin, of those without a code 0.

    From one window to the next the count of the character that comes in goes up and that of the one that leaves goes down. Comparing the
    codes with themselves, 1 to ``width`` places on, gives these counts for all steps at once; the entropy is the running sum of the changes.
    """
    n = len(codes)
    came, stays = np.zeros(n, np.int8 if width < 120 else np.int32), np.zeros(n - width, np.int8 if width < 120 else np.int32)
    for d in range(1, width + 1):
        same = codes[d:] == codes[: n - d]
        came[d:] += same  # its like in the window before
        stays += same[: n - width]  # the like of the character that leaves, counted with the one that comes in
    term = np.r_[0.0, np.arange(1, width + 2) * np.log2(np.arange(1, width + 2))]
    step = np.diff(term)
    total = step[came]
    total[width:] -= step[stays]
    entropy = np.log2(width) - np.cumsum(total)[width - 1 :] / width
    other = np.cumsum(np.r_[0, codes == 0])
    return np.flatnonzero((entropy >= bits - 1e-9) & (other[width:] == other[:-width]))


def windows_over(word: str, other: re.Pattern, width: int, bits: float) -> list[list[int]]:
    """Merged [start, end) of the windows whose Shannon entropy is at least ``bits`` and that hold no character that ``other`` matches.

    A word is gone through in stretches, in linear time and fixed memory.
    """
    if len(word) < width:
        return []
    clean = other.sub("\0", word)
    codes = np.frombuffer(clean.encode(), np.uint8) if clean.isascii() else np.frombuffer(clean.encode("utf-32-le"), np.uint32)
    hot = np.concatenate([a + _hot_starts(codes[a : a + STRETCH + width - 1], width, bits) for a in range(0, len(codes) - width + 1, STRETCH)])
    if not len(hot):
        return []
    new = np.flatnonzero(np.r_[True, hot[1:] - hot[:-1] > width])
    return np.stack([hot[new], hot[np.r_[new[1:], len(hot)] - 1] + width], axis=1).tolist()


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
)


def scan_secrets(docs: DataFrame, scanner: SecretScanner = SecretScanner()) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): counts per kind, sha256 of the base spans, and all spans as kind:start:end.

    Offsets are code points, ends exclusive. A map over partitions: no shuffle, nothing gathered.
    """

    def rows(ids, texts):
        columns: list[list] = [[] for _ in SCHEMA]
        for i, text in zip(ids, texts, strict=True):
            spans = scanner(text)
            base = [s for s in spans if s[0] != "entropy"]
            counts = [sum(s[0] == k for s in spans) for k in KINDS]
            for c, v in zip(columns, [i, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)], strict=True):
                c.append(v)
        return columns

    return map_texts(docs, rows, SCHEMA)
