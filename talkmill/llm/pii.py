"""Personal data: fixed patterns plus a linear-chain conditional random field over word-shape features.

The CRF is trained here by maximum likelihood from a small labelled table and decoded by Viterbi in numpy, many chains at a time.
A chain is the words of a line or sentence. Words without digit, @ or + share one feature set; ``Crf.plain_is_o`` proves from the
trained weights that a chain of only such words decodes to O throughout, so such chains need no decoding.

Null text counts as empty: no spans; in ``redact_pii`` it stays null. An empty table gives no rows. Repeated rows give repeated results,
and rows are judged one by one; of paths with equal scores Viterbi takes the first label. Texts are read whole, at any length. Only
doc_id and text are read, so further columns of any name do no harm; ``redact_pii`` keeps them as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, text_column

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", "email", "ip", "card", "phone", "ident")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ outwards, in linear time."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            floor = m.end()
        else:
            floor = max(floor, at + 1)
        at = text.find("@", at + 1)
    return out


def luhn(digits: str) -> bool:
    double = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    total = sum(int(d) if k % 2 == 0 else double[int(d)] for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's place, start, end) of the fixed patterns; matches that fail a check are dropped and not retried."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        if "." in text:
            out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


# ---------------------------------------------------------------- the CRF

WORD = re.compile(r"\S+")
BREAK = re.compile(r"\n+|(?<=[.!?])[ \t]+(?=[^\W\d_])")
MARKED = re.compile(r"[0-9@+]")
_SHAPE = str.maketrans("".join(map(chr, range(33, 127))), "".join("d" if c.isdigit() else "X" if c.isupper() else "x" if c.islower() else c for c in map(chr, range(33, 127))))


def shape(word: str) -> str:
    """Letters as x or X, digits as d, runs of letters cut to one; other characters of ASCII stay, all else is u."""
    s = "".join(c if ord(c) < 127 else "x" if c.isalpha() else "u" for c in word).translate(_SHAPE)
    return re.sub(r"([xX])[xX]*", r"\1", s)


def features(word: str) -> tuple[str, ...]:
    """Word-shape features. Words without digit, @ or + have the features 'plain' and, if so, 'end' (sentence mark at the end)."""
    if not MARKED.search(word):
        return ("plain", "end") if word[-1] in ".!?" else ("plain",)
    core = word.strip(".,;:!?()[]{}\"'<>|*%$&#")
    s = shape(core)
    digits = sum(c.isdigit() for c in core)
    return (
        "marked",
        "s=" + re.sub(r"d+", "d", s),
        "n=" + re.sub(r"d{2,}", lambda m: f"d{min(len(m[0]), 20)}", s),
        f"digits={min(digits, 20)}",
        f"at={min(core.count('@'), 2)}",
        f"dots={min(core.count('.'), 4)}",
        f"dashes={min(core.count('-'), 4)}",
        "plus" if core[:1] == "+" else "no plus",
        "letters" if re.search(r"[A-Za-z]", core) else "no letters",
        "all digits" if core.isdigit() else "mixed",
    )


@dataclass
class Crf:
    """Weights: emission (feature x label), transition (label x label), start (label)."""

    names: dict[str, int]
    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def scores(self, words: Sequence[str]) -> np.ndarray:
        cache = self.__dict__.setdefault("_cache", {})
        rows = []
        for w in words:
            row = cache.get(w)
            if row is None:
                row = self.emit[[k for f in features(w) if (k := self.names.get(f)) is not None]].sum(axis=0)
                if len(cache) < 50_000 and len(w) <= 100:
                    cache[w] = row
            rows.append(row)
        return np.array(rows).reshape(len(words), len(self.start))

    def plain_is_o(self) -> bool:
        """Whether every chain of plain words provably decodes to O: at each word O wins by more than all moves could give back."""
        for end in ((), ("end",)):
            row = self.emit[[self.names[f] for f in ("plain", *end) if f in self.names]].sum(axis=0)
            gain = (self.move.max() - self.move[0, 0]) * 2 + max(0.0, (self.start - self.start[0]).max())
            if not (row[0] - row[1:]).min() > gain:
                return False
        return True

    def decode(self, chains: Sequence[Sequence[str]]) -> list[np.ndarray]:
        """Viterbi for many chains at once; chains are handled by length so that short ones do not wait for long ones."""
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(chains)
        order = sorted((i for i in range(len(chains)) if len(chains[i])), key=lambda i: len(chains[i]))
        at = 0
        while at < len(order):
            group, cells = [], 0
            while at < len(order) and (not group or (cells < 200_000 and len(chains[order[at]]) <= 2 * len(chains[group[0]]) + 8)):
                group.append(order[at])
                cells += len(chains[order[at]])
                at += 1
            for i, path in zip(group, self._viterbi([self.scores(chains[i]) for i in group]), strict=True):
                out[i] = path
        return out

    def _viterbi(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        n, long, k = len(scores), max(map(len, scores)), len(self.start)
        sizes = np.array([len(s) for s in scores])
        emit = np.zeros((long, n, k))
        for i, s in enumerate(scores):
            emit[: len(s), i] = s
        best = emit[0] + self.start
        back = np.zeros((long, n, k), np.int8)
        for t in range(1, long):
            step = best[:, :, None] + self.move
            back[t] = step.argmax(axis=1)
            best = np.where((sizes > t)[:, None], step.max(axis=1) + emit[t], best)
        label = best.argmax(axis=1)
        path = np.zeros((long, n), np.int8)
        for t in range(long - 1, -1, -1):
            path[t] = label
            if t:
                label = np.where(sizes > t, back[t][np.arange(n), label], label)
        return [path[: sizes[i], i] for i in range(n)]


def train_crf(table: Sequence[tuple[Sequence[str], Sequence[str]]], labels: Sequence[str] = LABELS, steps: int = 150, l2: float = 0.02) -> Crf:
    """Maximum likelihood with an L2 term, by full gradients (forward-backward) and Adam; deterministic."""
    place = {x: i for i, x in enumerate(labels)}
    names: dict[str, int] = {}
    chains = [([[names.setdefault(f, len(names)) for f in features(w)] for w in words], [place[t] for t in tags]) for words, tags in table]
    n, k = len(names), len(labels)
    theta = np.zeros(n * k + k * k + k)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    seen = np.zeros_like(theta)
    cut = (n * k, n * k + k * k)
    split = lambda x: (x[: cut[0]].reshape(n, k), x[cut[0] : cut[1]].reshape(k, k), x[cut[1] :])
    for feats, tags in chains:
        e, mv, st = split(seen)
        st[tags[0]] += 1
        for t, f in enumerate(feats):
            np.add.at(e, (f, tags[t]), 1)
            if t:
                mv[tags[t - 1], tags[t]] += 1
    for step in range(1, steps + 1):
        emit, move, start = split(theta)
        grad = l2 * theta - seen
        ge, gm, gs = split(grad)
        for feats, _ in chains:
            x = np.array([emit[f].sum(axis=0) for f in feats])
            a, b = np.zeros_like(x), np.zeros_like(x)
            a[0] = start + x[0]
            for t in range(1, len(x)):
                a[t] = x[t] + np.logaddexp.reduce(a[t - 1][:, None] + move, axis=0)
            for t in range(len(x) - 2, -1, -1):
                b[t] = np.logaddexp.reduce(move + x[t + 1] + b[t + 1], axis=1)
            z = np.logaddexp.reduce(a[-1])
            p = np.exp(a + b - z)
            gs += p[0]
            for t, f in enumerate(feats):
                np.add.at(ge, f, p[t])
                if t:
                    gm += np.exp(a[t - 1][:, None] + move + x[t] + b[t] - z)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta - 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Crf(names, *(x.copy() for x in split(theta)))


#: The small labelled table, invented: words between braces are labelled, all others are O.
LABELLED = """
Please write to {email:anna.berg@post.example.org} before Monday.
Her new address is {email:k_moor77@mail3.example.net}, not the old one.
Mail {email:office@town.example} or call {phone:+44} {phone:20} {phone:7946} {phone:0958} today.
Ring {phone:+1} {phone:(202)} {phone:555-0143} after six.
Ring {phone:(202)} {phone:555-0188} after six and ask for the clerk.
The desk answers on {phone:202-555-0117} at all hours.
The desk answers on {phone:555-0190-22} now and then.
You reach us at {phone:+49-30-901820} in winter.
You reach us at {phone:+33.1.70.18.99.00} in winter.
Call {phone:(415)} {phone:555-2671} or {phone:415-555-2672}.
The host {ip:192.0.2.17} refused the line.
The host {ip:198.51.100.4:8080} refused the line.
Traffic from {ip:203.0.113.99} and {ip:10.0.0.8} was cut.
Route {ip:2001:db8:0:1::7f} stays up for a week.
He paid with {card:4111111111111111} at the door.
He paid with {card:5500} {card:0000} {card:0000} {card:0004} at the door.
She used {card:4012-8888-8888-1881} for the tickets.
The number {card:378282246310005} was refused twice.
The number {card:3782} {card:822463} {card:10005} was refused twice.
His number is {ident:078-05-1120} and he knows it.
The claim of {ident:219-09-9999} was paid in full.
Paid from {ident:DE89370400440532013000} to a friend.
Paid from {ident:GB29NWBK60161331926819} to a friend.
In 1987 the mill had 24 rooms and 3 wheels.
Version 4.0 and version 2.11.3 differ in 17 places.
The bill came to 1,250.75 in all, or 12% more.
On 2021-05-17 at 10:45 the doors closed.
Chapter 12, page 340, line 7 is missing.
It sold 1200 copies, then 35000, then 7.
The code a1b2c3 and the part X200 fit well.
Licensed under BY-NC 4.0. Version 3.0 came later.
Row 15 | 27 | 93 | 1004 | end of table.
Add 2+2 and 3+4 and write C++ beside it.
He wrote @home and left at once.
The batch f33e61083db5dbdf was built in 2019.
A long word list follows here without any number at all.
Nothing in this line is private, and it goes on for quite some time, as prose does.
The mill stood by the water. It was old. Nobody came.
Key 9f8e7d6c5b4a39281706f5e4d3c2b1a0 was made on day 12.
Build 1234567 took 89 s and 4096 MB.
Item 20240115 costs 9.99 and item 20240116 costs 19.99.
Send the form to {email:r.weiss@uni.example.edu} or to {email:info@shop-24.example.com} this week.
Our clerk, {email:lena+post@home.example}, has the keys.
Write {email:j.doe@example.org}, {email:m_l@test.example} and wait.
You may call {phone:(646)} {phone:555-0102} or {phone:(312)} {phone:555-0199} at noon.
The office line is {phone:503-555-0161} and the fax is {phone:503-555-0162} since May.
Her phone, {phone:+1-415-555-0133}, is off.
Dial {phone:+41} {phone:44} {phone:668} {phone:1800} for help.
Dial {phone:+7} {phone:495} {phone:555} {phone:0147} for help.
Call {phone:+353-1-677-0098} from abroad.
Call {phone:+32.2.555.12.12} from abroad.
The ring at {phone:555-0123} woke the whole house.
Packets from {ip:172.16.254.1} reach {ip:198.51.100.200} in 3 ms.
Block {ip:192.0.2.5:443} and {ip:203.0.113.7:22} at once.
The server {ip:10.1.2.3} has been up for 42 days.
The router answers at {ip:fe80::1ff:fe23:4567:890a} and {ip:2001:db8::ff00:42:8329} only.
Charge {card:6011111111111117} with the rest.
Charge {card:3566002020360505} with the rest.
The card {card:5105-1051-0510-5100} ran out in 2019.
The card {card:4222} {card:2222} {card:2222} {card:2220} ran out in 2019.
Booked with {card:371449635398431} on 3 May.
Booked with {card:3714} {card:496353} {card:98431} on 3 May.
Her number {ident:123-45-6789} was on the list.
The form asks for {ident:457-55-5462} and a date.
We hold {ident:536-22-8726} on file since 2004.
Send it to {ident:FR7630006000011234567890189} by Friday.
The account {ident:NL91ABNA0417164300} was closed.
The account {ident:CH9300762011623852957} was closed.
From 1990 to 1995 it grew by 40% each year.
The index rose 2.5 points to 1,034.7 on Monday.
Rooms 101, 102 and 214-216 are shut until 2025.
Python 3.13.1 and Java 17.0.2 are in use, 2.4.0 is not.
The match ended 3-1 after 120 minutes.
Order 5550199 has 12 parts, order 12345 has none.
At 09:30:15 on 12/05/2023 the 4th train left.
Chapters 3-5 and pages 12-40 are new.
The hash 0cc175b9c0f1b6a831c399e269772661 stands in row 4.
The ids 8842, 8843 and x99-12 are free.
A 16-bit field of 4096 x 2160 cells, 8.8 million in all.
See @mill_town and #3 or #14 for more, at 5@2 each.
The sum 12+30 and the grade A+ were 1+1 too much.
"""


def labelled_table(text: str = LABELLED) -> list[tuple[list[str], list[str]]]:
    out = []
    for line in text.strip().splitlines():
        words, tags = [], []
        for w in line.split():
            m = re.fullmatch(r"(.*)\{(\w+):(.*)\}(.*)", w)
            words.append(m[1] + m[3] + m[4] if m else w)
            tags.append(m[2] if m else "O")
        out.append((words, tags))
    return out


@lru_cache(maxsize=1)
def default_crf() -> Crf:
    return train_crf(labelled_table())


@dataclass
class PiiFinder:
    """Finds (kind, start, end): base spans, then CRF spans (kinds crf_<label>) of words that no base span touches."""

    crf: Crf

    def __post_init__(self):
        self.skip_plain = self.crf.plain_is_o()

    def __call__(self, texts: Sequence[str | None]) -> list[list[tuple[str, int, int]]]:
        out, chains, where = [], [], []
        for i, text in enumerate(texts):
            text = text or ""
            out.append(sorted(base_spans(text)))
            if self.skip_plain and not MARKED.search(text):
                continue
            at = 0
            for stop in [*(m.end() for m in BREAK.finditer(text)), len(text)]:
                if not self.skip_plain or MARKED.search(text, at, stop):
                    spans = [m.span() for m in WORD.finditer(text, at, stop)]
                    if spans:
                        chains.append([text[a:b] for a, b in spans])
                        where.append((i, spans))
                at = stop
        for (i, spans), path in zip(where, self.crf.decode(chains), strict=True):
            if path.any():
                self._add(out[i], texts[i], spans, path)
        return [[(KINDS[k] if k < 4 else "crf_" + LABELS[k - 3], a, b) for k, a, b in sorted(s)] for s in out]

    def _add(self, found: list, text: str, spans: list, path: np.ndarray) -> None:
        base = [(a, b) for k, a, b in found if k < 4]
        t = 0
        while t < len(path):
            u = t
            while u + 1 < len(path) and path[u + 1] == path[t]:
                u += 1
            if path[t]:
                a, b = spans[t][0], spans[u][1]
                while a < b and text[b - 1] in ".,;:!?()[]{}\"'<>|*%$&#":
                    b -= 1
                while a < b and text[a] in ".,;:!?[]{}\"'<>|*%$&#":
                    a += 1
                if a < b and not any(x < b and a < y for x, y in base):
                    found.append((3 + int(path[t]), a, b))
            t = u + 1


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField("n_crf", T.LongType()), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
)


def find_pii(docs: DataFrame, crf: Crf | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): counts per kind, sha256 of the base spans, all spans as kind:start:end.

    Spans go by kind as listed, then start; offsets are code points, ends exclusive. A map over partitions: no shuffle.
    """
    crf = crf or default_crf()

    def rows(ids, texts, finder):
        columns: list[list] = [[] for _ in SCHEMA]
        for i, spans in zip(ids, finder(texts), strict=True):
            base = [s for s in spans if s[0] in KINDS]
            row = [i, *(sum(s[0] == k for s in spans) for k in KINDS), len(spans) - len(base), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)]
            for c, v in zip(columns, row, strict=True):
                c.append(v)
        return columns

    return map_texts(docs, rows, SCHEMA, lambda: PiiFinder(crf))


def redacted(text: str | None, spans: Sequence[tuple[str, int, int]]) -> str | None:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    if text is None or not spans:
        return text
    parts, at = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            parts += [text[at:a], f"[{k.removeprefix('crf_').upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def redact_pii(docs: DataFrame, column: str = "text", crf: Crf | None = None) -> DataFrame:
    """``docs`` with the personal data in ``column`` replaced by [EMAIL], [IP], [CARD], [PHONE] or [IDENT]; n_chars, if there, follows. All rows stay."""
    crf = crf or default_crf()
    clean = text_column(F.col(column), lambda texts, finder: [redacted(t, s) for t, s in zip(texts, finder(texts), strict=True)], T.StringType(), lambda: PiiFinder(crf))
    out = docs.withColumn(column, clean)
    return out.withColumn("n_chars", F.length(column).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
