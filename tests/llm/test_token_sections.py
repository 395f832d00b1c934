"""Tokens of every line, and those that cross its border, against a walk over bytes."""

import random

import public_tokenizers
import pytest

from weftline.llm import token_counts

R = random.Random(6)
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = ["the", "run", "\n\n", "\n", " \n ", "é", "日本語", "x" * 9, "  ", "\t\n", "don't", "12345", ".", "\r\n", "…\n\n\n"]
TEXTS = ["".join(R.choices([*WORDS, " "], k=R.randint(0, 60))) for _ in range(60)] + [None, "", "\n", "\n\n\n\n", "a\n", " \n \n", "word " * 3000 + "\n" + "tail\n" * 500]


def _slow(text, rule):
    encoding, _ = token_counts._encoder(PATH)
    raw = (text or "").encode()
    lines, begin = [], 0
    for i, c in enumerate(raw):
        if c == 10:
            lines.append((begin, i + 1))
            begin = i + 1
    if begin < len(raw) or not lines:
        lines.append((begin, len(raw)))
    counts, crossing, at = [0] * len(lines), [0] * len(lines), 0
    for token in encoding.encode_ordinary(text or ""):
        n = len(encoding.decode_single_token_bytes(token))
        parts = [max(0, min(e, at + n) - max(b, at)) for b, e in lines]
        touched = [i for i, p in enumerate(parts) if p]
        owner = touched[0] if rule == "first" else touched[-1] if rule == "last" else max(touched, key=lambda i: (parts[i], -i))  # noqa: B023
        counts[owner] += 1
        crossing[owner] += len(touched) > 1
        at += n
    ends = [len(raw[:e].decode("utf-8", "replace")) for _, e in lines]
    return [(i, ([0, *ends])[i], ends[i], counts[i], crossing[i], sum(counts)) for i in range(len(lines))]


@pytest.mark.parametrize("rule", ["first", "last", "largest"])
def test_every_section(spark, rule):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(4)
    got = {}
    for r in token_counts.by_line(docs, PATH, rule).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start_char, r.end_char, r.n_tokens, r.n_crossing, r.doc_tokens))
    assert {i: sorted(rows) for i, rows in got.items()} == {i: _slow(t, rule) for i, t in enumerate(TEXTS)}
    assert sum(r[4] for rows in got.values() for r in rows) > 30
