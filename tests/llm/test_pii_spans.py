"""The personal-data model against slow versions of the same, on random texts; long texts; ids beside nulls."""

import random
import re
import time

import numpy as np
import pytest

from weftline.llm import pii

R = random.Random(8)
ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+\Z")
NUMBER = re.compile(r"[+(]?[0-9][0-9 ().-]*[0-9]\Z")


def _texts(n, alphabet="01259a@.-+ ()Zé_/,\n", most=60):
    return ["".join(R.choices(alphabet, k=R.randint(0, most))) for _ in range(n)]


def _slow_stretches(text):
    return [(m.start(), m[0]) for m in re.finditer(r"[^\s]*[0-9@][^\s]*(?:[\x20][^\s]*[0-9@(][^\s]*)*", text)]


def _slow_segments(s):
    """(start, end, features) of a stretch's candidates, one by one."""
    units = [m.span() for m in re.finditer(r"[0-9]+|[A-Za-z]+|.", s, re.DOTALL)]
    out = []
    for i in range(len(units)):
        for j in range(i, min(len(units), i + pii.MAX_UNITS)):
            a, b = units[i][0], units[j][1]
            x = s[a:b]
            d = re.sub("[^0-9]", "", x)
            n, ascii_ = len(d), lambda c: c.isascii() and c.isalnum()
            numeric = bool(re.fullmatch(r"\+?[0-9 ().-]*", x)) and (n >= 7 or x.count(".") == 3)
            addressed = bool(re.fullmatch(r"[A-Za-z0-9._%+@-]*", x)) and x.count("@") == 1
            if not ((x[0] in "+(" or ascii_(x[0])) and ascii_(x[-1]) and (numeric or addressed)):
                continue
            number, address, at = bool(NUMBER.match(x)), bool(ADDRESS.match(x)), "@" in x
            quad = bool(re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", x)) and all(int(p) <= 255 for p in x.split("."))
            before, after = s[a - 1 : a], s[b : b + 1]
            f = [1, address, at and not address, quad, number and not quad, number and 13 <= n <= 19, number and 13 <= n <= 19 and pii.luhn(d), number and 9 <= n <= 12, number and n <= 8, x[0] == "+", x[0] == "(" or ")" in x, before.isalnum(), after.isalnum(), before in tuple("+.-@_/"), after in ("@", "_", "/"), any(c in " -." for c in x), n in (15, 16), len(set(d)) <= 2]
            out.append((a, b, np.array(f, float)))
    return out, units


def test_stretches_and_features_equal_slow_ones():
    for t in [*_texts(400), *_texts(200, "0123456789 -.+()", 90), *(t for t, _ in pii.samples(60, seed=4))]:
        assert pii._stretches(t) == _slow_stretches(t)
        for _, s in pii._stretches(t):
            u = pii.Units([s])
            got = {(int(u.start[i]) - 1, int(u.end[j - 1]) - 1): f for ii, jj, ff in u.segments() for i, j, f in zip(ii, jj, ff, strict=True)}
            want = {(a, b): f for a, b, f in _slow_segments(s)[0]}
            assert got.keys() == want.keys()
            assert all((got[k] == want[k]).all() for k in want), [(s[k[0] : k[1]], got[k] - want[k]) for k in want if (got[k] != want[k]).any()][:2]


def _slow_found(text, model):
    out = []
    for at, s in _slow_stretches(text):
        segments, units = _slow_segments(s)
        begin = {a: i for i, (a, _) in enumerate(units)}
        stop = {b: i + 1 for i, (_, b) in enumerate(units)}
        best, back = [0.0] * (len(units) + 1), [None] * (len(units) + 1)
        for j in range(1, len(units) + 1):
            best[j] = best[j - 1]
            for a, b, f in segments:
                if stop[b] == j:
                    score = model.weights @ f
                    k = int(score.argmax())
                    if best[begin[a]] + score[k] > best[j] + 1e-12:
                        best[j], back[j] = best[begin[a]] + score[k], (begin[a], a, b, k)
        j, found = len(units), []
        while j:
            if back[j]:
                j, a, b, k = back[j]
                found.append((pii.KINDS[k], at + a, at + b))
            else:
                j -= 1
        out += found[::-1]
    return out


def test_decoding_equals_slow_viterbi_and_batches():
    model = pii.trained()
    texts = [*_texts(150), *(t for t, _ in pii.samples(150, seed=21)), "", "mail a.b@x.org 10.0.0.1\n+1 (017) 555-7713 4111 1111 1111 1111"]
    want = [_slow_found(t, model) for t in texts]
    assert [pii.found_spans(t, model) for t in texts] == want
    assert pii.found_in(texts, model) == want and sum(map(len, want)) > 100
    for t, found in zip(texts, want, strict=True):
        base = pii.base_spans(t)
        every = base + [f for f in found if not any(a < f[2] and f[1] < b for _, a, b in base)]
        assert pii.all_spans(t, model) == (base, sorted(every, key=lambda s: (pii.KINDS.index(s[0]), s[1])))


def test_card_and_phone_equal_plain_patterns():
    for t in [*_texts(1500, "0123456789 -", 70), *_texts(1500, "+0123 ().-a", 60), *("x " + d + c for d in ["411111111111111", "4111-1111-1111 111", "37828224631000"] for c in "0123456789")]:
        cards = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and pii.luhn(d)]
        phones = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        got = pii.base_spans(t)
        assert [(a, b) for k, a, b in got if k == "card"] == cards and [(a, b) for k, a, b in got if k == "phone"] == phones


@pytest.mark.parametrize("piece, n", [("a", 300_000), ("1", 300_000), ("é", 300_000), ("a1b2c3d4", 30_000), ("a@a", 80_000), ("me.you@x.org 10.0.0.1 4111111111111111 +1 (017) 555-7713 (017) 555-1234 ", 3_000), ("1 ", 60_000), ("+1((", 60_000), ("1.2.3.4.", 12_000)], ids=range(9))
def test_long_texts(piece, n):
    """Twice the text takes about twice the time, on a machine of any speed."""
    model = pii.trained()

    def seconds(k):
        text, best = piece * k + "1", 1e9
        for _ in range(3):
            began = time.process_time()
            base, every = pii.all_spans(text, model)
            best = min(best, time.process_time() - began)
            assert set(base) <= set(every)
        return best

    assert seconds(2 * n) < 3 * seconds(n) + 0.1


def test_ids_and_empty_tables(spark):
    schema = "doc_id long, text string, spans string"
    rows = [(2**53 + 1, "a@b.cc", None), (None, None, "x"), (2**53 + 1, "a@b.cc", None), (5, "", "")]
    got = pii.scan(spark.createDataFrame(rows, schema).coalesce(1)).collect()
    assert [(r.doc_id, r.n_email, r.spans) for r in got] == [(2**53 + 1, 1, "email:0:6"), (None, 0, ""), (2**53 + 1, 1, "email:0:6"), (5, 0, "")]
    assert pii.scan(spark.createDataFrame([], schema)).collect() == []
