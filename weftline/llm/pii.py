"""Personal data: fixed forms, and spans found by a semi-Markov conditional random field.

A text's stretches with digits or "@" are cut into units (runs of digits, runs of letters, single other characters).
The model scores whole segments of up to MAX_UNITS units with features of the entire span (digit counts, Luhn, dotted
quad, address form, borders) for each kind, and other units one by one; a bounded-segment Viterbi pass picks boundaries
and kinds together.  It is trained by maximum likelihood (forward-backward) on labelled samples drawn from templates
with a fixed seed.  Its spans are added where no fixed form is.  Features come from sums over a text's characters, so time
and memory grow with the text, whatever is in it.

Defined results: null and empty texts have no spans; whole texts are read; base spans of unlike kinds may overlap, added
ones overlap nothing; repeated rows each get a row; extra columns are ignored.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of the address form; each "@" is tried once, with all of the local part before it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        else:
            end = max(end, at)
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed forms, by kind as listed, then by start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.sub("", m[0])) <= 15]
    return out


# The semi-Markov model

MAX_UNITS = 24
#: Stretches with digits or "@": words that hold one, joined by single spaces to others.  Possessive, so that no character is read twice.
_REGION = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20[^\s0-9@(]*+[0-9@(]\S*+)*+")
N_FEATURES = 18
#: Segment starts worked on at a time.
STARTS = 50_000


def _among(codes: np.ndarray, chars: str) -> np.ndarray:
    return np.isin(codes, np.frombuffer(chars.encode("utf-32-le"), "<u4"))


def _before(x: np.ndarray) -> np.ndarray:
    """Sums of what stands before each place."""
    return np.r_[0, np.cumsum(x, dtype=np.int64)]


class Units:
    """The units of some stretches of text, in order, and the segments of them that can be entities.

    Segments are numbers (digits and what may part them, with seven digits or three dots) or have one "@" among the letters
    of addresses; they begin and end as entities do and stay inside their stretch.
    """

    def __init__(self, stretches: list[str]) -> None:
        text = "\n" + "\n".join(stretches) + "\n"
        c = self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        digit = (c >= 48) & (c <= 57)
        letter = (c >= 65) & (c <= 90) | (c >= 97) & (c <= 122)
        kind = digit * 1 + letter * 2
        new = (kind == 0) | np.r_[True, kind[1:] != kind[:-1]]
        self.start = np.flatnonzero(new)
        self.end = np.r_[self.start[1:], len(c)]
        #: Where each stretch's first unit is: after its line feed.
        self.first_unit = np.flatnonzero(c[self.start] == 10)[:-1] + 1
        at, dot = c == 64, c == 46
        self.digits, self.dots, self.ats = _before(digit), _before(dot), _before(at)
        self.no_number = _before(~(digit | _among(c, " ().-")))
        self.no_address = _before(~(digit | letter | _among(c, "._%+-@")))
        self.no_domain = _before(~(digit | letter | _among(c, ".-")))
        self.twice = _before(dot & np.r_[dot[1:], False])
        self.parting, self.closing = _before(_among(c, " -.")), _before(c == 41)
        self.next_at = np.flatnonzero(at)
        d = c[digit].astype(np.int64) - 48
        twice, odd = d * 2 - 9 * (d > 4), np.arange(len(d)) % 2 == 1
        self.luhn = [_before(np.where(odd, twice, d)), _before(np.where(odd, d, twice))]  # by the parity of the last digit
        self.of_digit = [_before(digit & (c == 48 + k)) for k in range(10)]
        self.alnum = digit | letter
        other = np.unique(c[~self.alnum & (c > 127)])
        self.wordlike = self.alnum | np.isin(c, other[[chr(x).isalnum() for x in other]] if len(other) else other)
        #: Per digit unit: how many digits, and their value if they are three at most.
        n = self.end - self.start
        v = np.where(digit[self.start] & (n <= 3), 0, 999)
        for k in range(3):
            v = np.where((v < 999) & (n > k), v * 10 + c[np.minimum(self.start + k, len(c) - 1)].astype(np.int64) - 48, v)
        self.value = v

    def segments(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first unit, last unit + 1, features) of all of them, by blocks of starts and by length in these."""
        c, n = self.codes, len(self.start)
        opens = self.alnum[self.start] | _among(c[self.start], "+(")
        opens = np.flatnonzero(opens & (self.start > 0))
        for lo in range(0, len(opens), STARTS):
            some = opens[lo : lo + STARTS]
            for size in range(1, MAX_UNITS + 1):
                i = some[: np.searchsorted(some, n - size, side="right")]
                a, b = self.start[i], self.end[i + size - 1]
                digits, ats = self.digits[b] - self.digits[a], self.ats[b] - self.ats[a]
                number = (self.no_number[b] - self.no_number[a + (c[a] == 43)] == 0) & ((digits >= 7) | (self.dots[b] - self.dots[a] == 3))
                address = (self.no_address[b] - self.no_address[a] == 0) & (ats == 1)
                ok = (number | address) & self.alnum[b - 1]
                if ok.any():
                    yield i[ok], i[ok] + size, self._features(i[ok], size)

    def _features(self, i: np.ndarray, size: int) -> np.ndarray:
        """What whole spans of so many units look like."""
        c = self.codes
        a, b = self.start[i], self.end[i + size - 1]
        n = self.digits[b] - self.digits[a]
        has_at = self.ats[b] > self.ats[a]
        m = self.next_at[np.minimum(np.searchsorted(self.next_at, a), len(self.next_at) - 1)] if len(self.next_at) else a
        m = np.where(has_at, m, a)
        address = has_at & (m > a) & (m + 1 < b) & (self.no_domain[b] - self.no_domain[m + 1] == 0) & (self.dots[b] > self.dots[m + 1]) & (self.twice[b - 1] == self.twice[m + 1]) & (c[np.minimum(m + 1, len(c) - 1)] != 46)
        signed = (c[a] == 43) | (c[a] == 40)
        number = ~has_at & (self.no_number[b] - self.no_number[a + (c[a] == 43)] == 0) & (self.alnum[a + signed]) & (b - a - signed >= 2)
        quad = np.zeros(len(i), bool)
        if size == 7:
            quad = np.all([self.value[i + k] <= 255 for k in (0, 2, 4, 6)], axis=0) & np.all([c[self.start[i + k]] == 46 for k in (1, 3, 5)], axis=0)
        lo, hi = self.digits[a], self.digits[b]
        total = np.where(hi % 2 == 1, self.luhn[0][hi] - self.luhn[0][lo], self.luhn[1][hi] - self.luhn[1][lo])
        carded = number & (n >= 13) & (n <= 19)
        kinds = sum((x[b] > x[a]).astype(np.int64) for x in self.of_digit)
        before, after = c[a - 1], c[np.minimum(b, len(c) - 1)]
        return np.stack([
            np.ones(len(i)), address, has_at & ~address, quad, number & ~quad, carded, carded & (total % 10 == 0), number & (n >= 9) & (n <= 12),
            number & (n <= 8), c[a] == 43, (c[a] == 40) | (self.closing[b] > self.closing[a]), self.wordlike[a - 1], self.wordlike[np.minimum(b, len(c) - 1)], _among(before, "+.-@_/"), _among(after, "@_/"), self.parting[b] > self.parting[a], (n == 16) | (n == 15), kinds <= 2,
        ], axis=1).astype(float)


class SemiMarkov:
    """weights: kinds x features; a unit outside any entity scores `other`."""

    def __init__(self, weights: np.ndarray, other: float = 0.0) -> None:
        self.weights, self.other = weights, other

    def _by_end(self, n: int, segments: list) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        ends: list[list] = [[] for _ in range(n + 1)]
        for i, j, f in segments:
            ends[j].append((i, self.weights @ f, f))
        return ends

    def gradient(self, n: int, segments: list, gold: dict[tuple[int, int], int]) -> np.ndarray:
        """Of the log-likelihood: features of the gold segments less those expected."""
        ends = self._by_end(n, segments)
        alpha = np.full(n + 1, -np.inf)
        alpha[0] = 0
        for j in range(1, n + 1):
            alpha[j] = np.logaddexp.reduce([alpha[j - 1] + self.other, *(alpha[i] + x for i, s, _ in ends[j] for x in s)])
        beta = np.full(n + 1, -np.inf)
        beta[n] = 0
        for j in range(n, 0, -1):
            beta[j - 1] = np.logaddexp(beta[j - 1], beta[j] + self.other)
            for i, s, _ in ends[j]:
                beta[i] = np.logaddexp(beta[i], beta[j] + np.logaddexp.reduce(s))
        g = np.zeros_like(self.weights)
        for j in range(1, n + 1):
            for i, s, f in ends[j]:
                g -= np.exp(alpha[i] + s + beta[j] - alpha[n])[:, None] * f
        for i, j, f in segments:
            if (i, j) in gold:
                g[gold[i, j]] += f
        return g

    def decode(self, units: Units) -> list[tuple[int, int, int]]:
        """The best segmentation's entities: (first unit, last unit + 1, kind).

        Units outside of entities score `other` each; only segments that beat them can be in it, so only those are kept.
        """
        kept = []
        for i, j, f in units.segments():
            s = f @ self.weights.T
            k = s.argmax(1)
            s = s[np.arange(len(k)), k] - self.other * (j - i)
            good = s > 0
            kept.append(np.stack([j[good], i[good], k[good], s[good]]))
        if not kept:
            return []
        ends, starts, kinds, gains = np.concatenate(kept, axis=1)
        order = np.lexsort((starts, ends))
        at, best, back = [0], [0.0], [None]  # the best sum up to each end of a segment, ascending
        for j, i, k, s in zip(ends[order].astype(int).tolist(), starts[order].astype(int).tolist(), kinds[order].astype(int).tolist(), gains[order].tolist(), strict=True):
            p = bisect_right(at, i) - 1
            if best[p] + s > best[-1]:
                if at[-1] != j:
                    at.append(j)
                    best.append(0.0)
                    back.append(None)
                best[-1], back[-1] = best[p] + s, (p, i, k)
        out, p = [], len(at) - 1
        while back[p]:
            q, i, k = back[p]
            out.append((i, at[p], k))
            p = q
        return out[::-1]


def samples(n: int = 600, seed: int = 5) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Labelled texts from templates: (text, [(start, end, kind)]), entities among numbers that are none."""
    r, out = random.Random(seed), []
    digits = lambda k: "".join(r.choices("0123456789", k=k))
    word = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 9)))

    def card() -> str:
        d = digits(15)
        d += next(c for c in "0123456789" if luhn(d + c))
        return d if r.random() < 0.6 else r.choice(" -").join(d[i : i + 4] for i in range(0, 16, 4))

    def other() -> str:
        return r.choice([lambda: digits(r.randint(1, 8)), lambda: f"{r.randint(1950, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", lambda: f"{r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}", lambda: f"{digits(3)},{digits(3)}.{digits(2)}", lambda: f"{word()}@", lambda: f"@{word()}", lambda: digits(r.choice([10, 16, 22])), lambda: f"{word()}{digits(3)}", lambda: f"{r.randint(256, 999)}.{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}", lambda: "".join(r.choices("0123456789abcdef", k=40))])()

    made = [
        lambda: f"{word()}{r.choice(['', '.' + word(), digits(2)])}@{word()}.{r.choice(['com', 'org', 'net', 'de'])}",
        lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)),
        card,
        lambda: r.choice([f"+{r.randint(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}", f"+{r.randint(1, 99)} {digits(3)} {digits(3)} {digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"+{digits(11)}"]),
    ]
    for _ in range(n):
        text, spans = word(), []
        for _ in range(r.randint(1, 3)):
            text += " " + r.choice([word(), other()]) + " "
            if r.random() < 0.6:
                k = r.randrange(4)
                s = made[k]()
                spans.append((len(text), len(text) + len(s), k))
                text += s + r.choice([" ", ", ", ". "])
            text += word()
        out.append((text, spans))
    return out


def _stretches(text: str) -> list[tuple[int, str]]:
    return [(m.start(), m[0]) for m in _REGION.finditer(text)] if text else []


@lru_cache(maxsize=1)
def trained(n: int = 600, epochs: int = 6, rate: float = 0.2, decay: float = 0.002) -> SemiMarkov:
    model = SemiMarkov(np.zeros((len(KINDS), N_FEATURES)))
    data = []
    for text, spans in samples(n):
        where = {(a, b): k for a, b, k in spans}
        for at, stretch in _stretches(text):
            units = Units([stretch])
            segments = [(int(i), int(j), f) for ii, jj, ff in units.segments() for i, j, f in zip(ii, jj, ff, strict=True)]
            if segments:
                place = lambda i, j: (at + int(units.start[i]) - 1, at + int(units.end[j - 1]) - 1)  # noqa: B023, E731
                data.append((len(units.start), segments, {(i, j): where[place(i, j)] for i, j, _ in segments if place(i, j) in where}))
    for e in range(epochs):
        for n_units, segments, gold in data:
            model.weights += rate / (1 + e) * (model.gradient(n_units, segments, gold) - decay * model.weights)
    return model


def found_in(texts: list[str], model: SemiMarkov) -> list[list[tuple[str, int, int]]]:
    """The model's spans in each whole text, worked out for all texts at once."""
    out: list[list] = [[] for _ in texts]
    stretches = [(t, at, s) for t, text in enumerate(texts) for at, s in _stretches(text)]
    if stretches:
        units = Units([s for *_, s in stretches])
        for i, j, k in model.decode(units):
            t, at, _ = stretches[n := int(np.searchsorted(units.first_unit, i, side="right")) - 1]
            shift = at - int(units.start[units.first_unit[n]])
            out[t].append((KINDS[k], shift + int(units.start[i]), shift + int(units.end[j - 1])))
    return out


def found_spans(text: str, model: SemiMarkov) -> list[tuple[str, int, int]]:
    """The model's spans in the whole text."""
    return found_in([text], model)[0]


def with_found(base: list[tuple[str, int, int]], found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """base and what was found where no base span is, by kind and start."""
    if not found:
        return base
    starts, reach = [], []  # of base spans in order, and how far those up to each one reach
    for a, b in sorted((a, b) for _, a, b in base):
        starts.append(a)
        reach.append(max(b, reach[-1] if reach else 0))
    more = []
    for k, a, b in found:
        p = bisect_left(starts, b)
        if not p or reach[p - 1] <= a:
            more.append((k, a, b))
    return sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1])) if more else base


def all_spans(text: str, model: SemiMarkov) -> tuple[list, list]:
    """base_spans(), and those with the model's, both by kind and start."""
    base = base_spans(text)
    return base, with_found(base, found_spans(text, model))


def _joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, model: SemiMarkov | None = None) -> DataFrame:
    """docs' doc_id with counts of the fixed forms, the digest of their spans, and all spans."""
    model = model or trained()

    def start():
        def make(texts: list[str | None]) -> dict:
            bases = [base_spans(t or "") for t in texts]
            found = found_in([t or "" for t in texts], model)
            out: dict = {f"n_{k}": [sum(s[0] == k for s in base) for base in bases] for k in KINDS}
            out["base_sha256"] = [hashlib.sha256(_joined(base).encode()).hexdigest() for base in bases]
            out["spans"] = [_joined(with_found(base, f)) for base, f in zip(bases, found, strict=True)]
            return out

        return make

    return map_rows(docs.select("doc_id", "text"), "text", start, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", 500)
