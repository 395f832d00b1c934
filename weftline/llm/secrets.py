"""Secret scans: fixed forms, and runs of characters that a Markov model of random strings explains better than one of
ordinary identifiers.

Two character-bigram models are trained from labelled samples: random strings (drawn here from the alphabets keys are
drawn from, with a fixed seed) and ordinary words (from up to `bound` labelled documents of good quality, compound
identifiers made of them, and rules, dates and other common forms).  A run of at least MIN_RUN characters, other than
one character repeated, is a secret when its log-likelihood ratio a character is over the threshold, which is set on the
samples so that no ordinary one passes.

Defined results: null and empty texts have no spans; whole texts are read; what a fixed form covers is not
reported again, and the parts of its run beside it are scored; repeated rows each get a row; extra columns are ignored;
without labelled documents the words built in here train the model; an empty table gives no rows.  Offsets are code
points, ends exclusive.  Time grows with the text, however many spans it has.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
MIN_RUN = 16
LABELLED_ROWS = 2000
#: Ordinary words for compound identifiers.
COMMON_WORDS = "account action add address all api app array base batch block buffer build button cache call check class client close code color column config content context count create current data date default delete end error event example field file filter find first flag form format function get group handler header height id image index init input instance item key label last length level line link list load local log main map max message method min mode model module name network new node number object offset option order output page panel param parent parse path point port process property query read record request reset response result return root row run save schema script select server service session set size source start state status stop string style system table target task test text time title token tree type update url user util value version view width window write".split()
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: The row of the models' tables for each byte.
CODES = np.full(256, len(ALPHABET))
CODES[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed forms, by start, then by kind as listed."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


class Markov:
    """The log-likelihood ratio of two bigram models as one table; rows and columns are characters of ALPHABET, or any other."""

    def __init__(self, table: np.ndarray, threshold: float) -> None:
        self.table, self.threshold = table, threshold

    @staticmethod
    def _codes(s: str) -> np.ndarray:
        return CODES[np.frombuffer(s.encode("ascii", "replace"), np.uint8)]

    @classmethod
    def trained(cls, random_strings: list[str], ordinary: list[str]) -> "Markov":
        k, logs = len(ALPHABET) + 1, []
        for sample in (random_strings, ordinary):
            n = np.full((k, k), 0.5)
            for s in sample:
                c = cls._codes(s)
                np.add.at(n, (c[:-1], c[1:]), 1)
            logs.append(np.log(n / n.sum(1, keepdims=True)))
        model = cls(logs[0] - logs[1], 0.0)
        held = [model.ratio(s) for s in ordinary if len(s) >= MIN_RUN]
        model.threshold = max(0.5, max(held, default=0.0) + 0.1)
        return model

    def ratio(self, s: str) -> float:
        return float(self.ratios([s])[0])

    def ratios(self, parts: list[str]) -> np.ndarray:
        """The mean ratio a character of each of them, looked up for all at once; 0 for those of one character or none."""
        c = self._codes("".join(parts))
        stop = np.cumsum([len(p) for p in parts], dtype=np.int64)
        steps = np.maximum(np.array([len(p) for p in parts], np.int64) - 1, 0)
        sums = np.r_[0, np.cumsum(self.table[c[:-1], c[1:]])] if len(c) > 1 else np.zeros(2)
        return np.where(steps > 0, sums[np.maximum(stop - 1, 0)] - sums[np.maximum(stop - 1 - steps, 0)], 0.0) / np.maximum(steps, 1)


def random_samples(n: int = 4000, seed: int = 7) -> list[str]:
    r = random.Random(seed)
    alphabets = ["0123456789abcdef", ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[:62] + "_-", ALPHABET[26:62]]
    return ["".join(r.choices(alphabets[i % len(alphabets)], k=r.randint(16, 64))) for i in range(n)]


def identifier_samples(words: list[str], n: int = 4000, seed: int = 11) -> list[str]:
    r, out = random.Random(seed), []
    for i in range(n):
        w = r.choices(words, k=r.randint(2, 6))
        form = i % 6
        s = "_".join(w) if form == 0 else "-".join(w) if form == 1 else w[0] + "".join(x.title() for x in w[1:]) if form == 2 else "/".join(w) if form == 3 else "_".join(w).upper() if form == 4 else "".join(w)
        out.append(s + (str(r.randint(0, 2030)) if i % 4 == 0 else ""))
    return out


def form_samples(words: list[str], n: int = 400, seed: int = 17) -> list[str]:
    """Ordinary forms that are no identifiers: rules, the alphabet, dates and key=value."""
    r = random.Random(seed)
    out = [c * k for c in "-=_/+" for k in (16, 20, 40)] + [ALPHABET[:26], ALPHABET[26:52], ALPHABET[52:62] * 2] * 20
    for i in range(n):
        day = [f"{r.randint(1900, 2099)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}" for _ in range(2)]
        out += ["/_-="[i % 4].join(day), "=".join(r.choices(words, k=2))]
    return out


def train(docs: DataFrame, labels: DataFrame | None = None, bound: int = LABELLED_ROWS, least: int = 2) -> Markov:
    """The model, from random strings and the words that at least `least` of up to `bound` documents labelled good hold
    (those with the smallest hashed ids); the bound on documents is the only one."""
    words = list(COMMON_WORDS)
    if labels is not None:
        good = labels.where("quality = 1 and toxic = 0 and doc_id is not null").select("doc_id").distinct()
        good = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        text = docs.join(F.broadcast(good), "doc_id", "left_semi").select(F.explode(F.array_distinct(F.split("text", "[^A-Za-z]+"))).alias("w")).where("length(w) > 1")
        words += sorted(r[0] for r in text.groupBy("w").count().where(F.col("count") >= least).collect())
    long = [w for w in words if len(w) >= 8]
    return Markov.trained(random_samples(), identifier_samples(words) + identifier_samples(COMMON_WORDS, seed=13) + form_samples(COMMON_WORDS) + long)


def _disjoint(spans: list[tuple[int, int, str]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what spans in order of their starts cover together."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b, _ in spans:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def all_spans(text: str, model: Markov) -> list[tuple[int, int, str]]:
    """base_spans() and, where they leave room, the runs that look random."""
    base = base_spans(text)
    starts, ends = _disjoint(base)
    more, k = [], 0
    for m in RUN.finditer(text):
        at, stop = m.span()
        while k < len(ends) and ends[k] <= at:
            k += 1
        while True:
            a, b = (starts[k], ends[k]) if k < len(starts) and starts[k] < stop else (stop, stop)
            part = text[at:a]
            if len(part) >= MIN_RUN and part.count(part[0]) < len(part):
                more.append((at, a, part))
            at = max(at, b)
            if at >= stop:
                break
            k += 1
    random_ = (model.ratios([part for *_, part in more]) > model.threshold).tolist() if more else []
    more = [(a, b, "random") for (a, b, _), yes in zip(more, random_, strict=True) if yes]
    order = (*KINDS, "random")
    return sorted(base + more, key=lambda s: (s[0], order.index(s[2]))) if more else base


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, model: Markov) -> DataFrame:
    """docs' doc_id with the counts of the fixed forms, the digest of their spans, and all spans."""

    def start():
        def make(texts: list[str | None]) -> dict:
            spans = [all_spans(t or "", model) for t in texts]
            bases = [[s for s in row if s[2] != "random"] for row in spans]
            out: dict = {f"n_{k}": [sum(s[2] == k for s in base) for base in bases] for k in KINDS}
            out["base_sha256"] = [hashlib.sha256(_joined(base).encode()).hexdigest() for base in bases]
            out["spans"] = [_joined(row) for row in spans]
            return out

        return make

    return map_rows(docs.select("doc_id", "text"), "text", start, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(docs: DataFrame, model: Markov, mask: str = "[secret]") -> DataFrame:
    """docs with every span in text replaced by mask, overlapping ones by one, and n_chars, where there is one, counted anew."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            if not text:
                return text
            out, end = [], 0
            for a, b, _ in all_spans(text, model):
                if a >= end:
                    out += [text[end:a], mask]
                end = max(end, b)
            return "".join(out) + text[end:] if out else text

        return texts.map(one, na_action="ignore")

    out = docs.withColumn("text", clean("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
