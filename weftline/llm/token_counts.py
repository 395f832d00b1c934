"""Token counts by offset-mapped attribution.

Each document is encoded once, whole.  Byte-level tokens spell the text, so their lengths give every token's span, and
an interval join (binary search of token borders among section borders) attributes them to the document's sections, or
to the fields it was joined from.  A token that crosses a border counts for the section that RULE names:

* first:   where the token begins;
* last:    where it ends;
* largest: where most of its bytes lie, the first of equals.

Sections are spans that follow one another without gaps; a section's trailing line break belongs to it.

Defined results: null and empty texts have one empty section without tokens; empty lines are sections of their own;
repeated rows each get their rows; extra columns are ignored; an empty table gives no rows.  Offsets are code points, ends
exclusive.  A text is encoded whole however long it is, in one task, which takes some 30 bytes for each of its tokens.
"""

from __future__ import annotations

import base64

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

RULE = "first"
_encoders: dict[str, tuple] = {}


def _encoder(path: str):
    """The encoding of a ranks file, and the bytes of each token."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:  # a vocabulary installed on every machine, not an input table
            ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
        length = np.zeros(max(ranks.values()) + 1, np.int64)
        for t, i in ranks.items():
            length[i] = len(t)
        _encoders[path] = (tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), length)
    return _encoders[path]


def attribute(token_lengths: np.ndarray, ends: np.ndarray, rule: str = RULE) -> tuple[np.ndarray, np.ndarray]:
    """For sections that end at the bytes `ends` (ascending): tokens of each, and how many of them cross a border."""
    stop = np.cumsum(token_lengths)
    start = stop - token_lengths
    first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop - 1, side="right")
    crossing = first != last
    owner = last.copy() if rule == "last" else first.copy()
    if rule == "largest":
        for i in np.flatnonzero(crossing):
            cuts = np.r_[start[i], ends[first[i] : last[i]], stop[i]]
            owner[i] = first[i] + int(np.diff(cuts).argmax())
    return np.bincount(owner, minlength=len(ends)), np.bincount(owner[crossing], minlength=len(ends))


def _line_ends(raw: np.ndarray) -> np.ndarray:
    """Byte ends of the lines; the last has none of its own if the text ends with a line break."""
    ends = np.flatnonzero(raw == 10) + 1
    return ends if len(ends) and ends[-1] == len(raw) else np.r_[ends, len(raw)]


def by_line(docs: DataFrame, ranks_path: str, rule: str = RULE) -> DataFrame:
    """A row for each line of each document: doc_id, section, start_char, end_char, n_tokens, n_crossing, doc_tokens."""

    def start():
        encoding, length = _encoder(ranks_path)

        def make(texts: list[str | None]) -> dict:
            parts = []
            for text in texts:
                raw = np.frombuffer((text or "").encode(), np.uint8)
                lengths = length[encoding.encode_to_numpy(text or "", disallowed_special=())]
                ends = _line_ends(raw)
                n, crossing = attribute(lengths, ends, rule)
                chars = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)][ends]
                parts.append((np.arange(len(ends)), np.r_[0, chars[:-1]], chars, n, crossing, np.full(len(ends), len(lengths))))
            names = ("section", "start_char", "end_char", "n_tokens", "n_crossing", "doc_tokens")
            return {None: np.repeat(np.arange(len(texts)), [len(p[0]) for p in parts])} | {c: np.concatenate(x) for c, x in zip(names, zip(*parts, strict=True), strict=True)}

        return make

    return map_rows(docs.select("doc_id", "text"), "text", start, "section long, start_char long, end_char long, n_tokens long, n_crossing long, doc_tokens long")


def by_field(rows: DataFrame, key: str, fields: list[str], ranks_path: str, separator: str = "\n", rule: str = RULE) -> DataFrame:
    """Rows' key with a count n_<field> for each field, encoded once as all fields joined; a separator belongs to the field before it."""

    def start():
        encoding, length = _encoder(ranks_path)

        def make(*columns: list[str | None]) -> dict:
            counts = []
            for values in zip(*columns, strict=True):
                texts = [v or "" for v in values]
                texts = [t + separator for t in texts[:-1]] + texts[-1:]
                ends = np.cumsum([len(t.encode()) for t in texts])
                counts.append(attribute(length[encoding.encode_to_numpy("".join(texts), disallowed_special=())], ends, rule)[0])
            return {f"n_{f}": x for f, x in zip(fields, np.array(counts, np.int64).T, strict=True)}

        return make

    given = [f"_{i}" for i in range(len(fields))]  # a field may be the key too
    texts = [F.col(f"`{f}`").cast("string").alias(g) for f, g in zip(fields, given, strict=True)]
    return map_rows(rows.select(F.col(f"`{key}`"), *texts), given, start, ", ".join(f"n_{f} long" for f in fields))
