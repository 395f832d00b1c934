"""Fingerprints stay what they were: phrases against a slow walk, likeness against sets."""

import random

import numpy as np

from weftline.llm import fingerprints as P

FULL = (1 << 64) - 1


def _mix(x):
    x = (x ^ x >> 30) * int(P._M1) & FULL
    x = (x ^ x >> 27) * int(P._M2) & FULL
    return x ^ x >> 31


def _toss(a, b):
    low = ((a ^ b) & -(a ^ b)).bit_length() - 1
    return 0 if a == b else 2 * low + (b >> low & 1)


def _phrases(names):
    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    s = [_mix(x * int(P._K1) + n & FULL) if n > 1 else x for x, n in runs]
    label, starts = s, [0]
    if len(s) > P.TOSSES + 2:
        for _ in range(P.TOSSES):
            label = [_toss(a, b) for a, b in zip(label, label[1:], strict=False)]
        starts += [i + P.TOSSES + 1 for i in range(len(label) - 2) if label[i] < label[i + 1] >= label[i + 2]]
    ends = [*starts[1:], len(s)]
    return [_mix(sum(_mix(s[i] ^ (i - lo + 1) * int(P._K1) & FULL) for i in range(lo, hi)) * int(P._K2) & FULL) for lo, hi in zip(starts, ends, strict=True)]


def test_phrases_are_those_of_a_slow_walk():
    r = random.Random(5)
    for n in [*range(1, 60), 500]:
        names = [ord(r.choice("ab c一\U0001f600")) for _ in range(n)]
        for _ in range(3):
            got = P.phrases(np.array(names, np.uint64)).tolist()
            assert got == (names := _phrases(names))


def test_likeness_is_that_of_sets():
    r = random.Random(6)
    for _ in range(300):
        a, b = (sorted(r.sample(range(40), r.randrange(1, 30))) for _ in range(2))
        both = sorted({*a, *b})[: max(len(a), len(b))]
        assert P.likeness(np.array(a, np.uint32), np.array(b, np.uint32)) == sum(x in a and x in b for x in both) / len(both)
    assert P.likeness(np.empty(0, np.uint32), np.empty(0, np.uint32)) == 1.0 and P.likeness(np.array([1], np.uint32), np.empty(0, np.uint32)) == 0.0
