"""Quality classifier by co-training.

Two views of a document, its text's content and its page's metadata (source, language, stated size; nothing of the text),
have a logistic model each.  In every round each model labels all documents that it is confident of for the other, which
is fitted to the labelled documents and these.  Both are then calibrated on labelled documents held out from training, and
a logistic combination of the calibrated views scores every document.

Up to LABELLED labelled documents, those with the smallest hashed ids, are fitted on the driver (a documented bound); of
documents that share an id the text with the smallest hash stands for it.  All other documents are unlabelled: their
features are a table in the shared folder, and a step of a fit needs only sums over it, added up in Spark.
Pseudo-labels weigh as much as the labelled documents at most, all together.

Defined results: null texts and columns are features of their own, never errors; without labels of both values every
document scores 1.0 and stays; repeated rows each get a row; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, map_rows, written

LABELLED, ROUNDS, STEPS = 6000, 3, 4
CONFIDENT = 0.97
THRESHOLD = 0.5
_MARKS = b"!?.,;:|#$%&*@<>{}[]()=+_-\"'/\\^~`"
_CLASS = np.zeros(256, np.int64)
for _c in range(256):
    _ch = chr(_c)
    _CLASS[_c] = 0 if 97 <= _c <= 122 else 1 if 65 <= _c <= 90 else 2 if 48 <= _c <= 57 else 3 if _c in b" \t\r\x0b\x0c" else 4 if _c == 10 else 5 if _c >= 128 else 6
for _i, _c in enumerate(_MARKS):
    _CLASS[_c] = 7 + _i
N_CLASSES = 7 + len(_MARKS)


def content_features(text: str | None) -> np.ndarray:
    """Shares of character classes, and how words repeat, shout and vary."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    share = np.bincount(_CLASS, weights=np.bincount(raw, minlength=256), minlength=N_CLASSES) / max(1, len(raw))
    words = raw.tobytes().split()
    n = max(1, len(words))
    most = Counter(words).most_common(1)[0][1] if words else 0
    again = sum(map(bytes.__eq__, words[1:], words[:-1]))
    shout = sum(map(bytes.isupper, words))
    odd = sum(1 for w in words if not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:")
    alone = sum(1 for w in words if len(w) == 1 and not w.isalnum())
    return np.r_[np.sqrt(share), len(set(words)) / n, most / n, again / n, shout / n, odd / n, alone / n, np.log1p(len(words)), np.mean([len(w) for w in words]) / 10 if words else 0, text is None]


def metadata_features(lang: str | None, source: str | None, n_chars: float | None) -> np.ndarray:
    """The page's language and source (hashed), and its size as stated."""
    out = np.zeros(16 + 32 + 5)
    out[xxhash.xxh32_intdigest(f"lang {lang}") % 16] = 1
    out[16 + xxhash.xxh32_intdigest(f"source {source}") % 32] = 1
    unknown = n_chars is None or np.isnan(n_chars)
    size = 0.0 if unknown else np.log1p(max(0.0, n_chars))
    out[48:] = size / 5, (size / 5) ** 2, unknown, lang is None, source is None
    return out


GIVEN = ["text", "lang", "source", "n_chars"]


def _views(texts: list, langs: list, sources: list, sizes: list) -> tuple[np.ndarray, np.ndarray]:
    return np.array([content_features(t) for t in texts]), np.array([metadata_features(la, so, n) for la, so, n in zip(langs, sources, sizes, strict=True)])


def _columns(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(*more, "text", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"))


def _featured(rows: DataFrame) -> DataFrame:
    """rows' other columns with the views as arrays of 32-bit floats."""

    def start():
        def make(*columns: list) -> dict:
            return dict(zip(("content", "metadata"), ([x.astype("<f4").tobytes() for x in v] for v in _views(*columns)), strict=True))

        return make

    return map_rows(rows, GIVEN, start, "content binary, metadata binary")


def _matrix(views: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(views), "<f4").reshape(len(views), -1).astype(float)


class Logistic:
    """Ridge logistic regression on features standardised as in its own sample.

    Each step goes to the minimum of the tightest quadratic that bounds the loss from above where the weights are, so that
    the loss falls with every step, on separable samples too.
    """

    def __init__(self, x: np.ndarray, ridge: float = 1.0) -> None:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        self.w = np.zeros(x.shape[1] + 1)
        self.penalty = np.r_[1e-6, np.full(x.shape[1], ridge)]

    def design(self, x: np.ndarray) -> np.ndarray:
        return np.c_[np.ones(len(x)), (x - self.mean) / self.scale]

    def sums(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The gradient of the rows' log-loss at w, and the curvature of its bound."""
        z = self.design(x)
        at = np.clip(z @ self.w, -30, 30)
        p = _p(at)
        bound = np.where(np.abs(at) < 1e-4, 0.25, (p - 0.5) / np.where(at == 0, 1, at))
        return z.T @ (p - y), (z * bound[:, None]).T @ z

    def step(self, g: np.ndarray, h: np.ndarray) -> float:
        change = np.linalg.solve(h + np.diag(self.penalty), g + self.penalty * self.w)
        self.w = self.w - change
        return float(np.abs(change).max())

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Logistic":
        for _ in range(200):
            if self.step(*self.sums(x, y)) < 1e-5:
                break
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.design(x) @ self.w


def _p(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


Sums = list[tuple[float, np.ndarray, np.ndarray]]


class CoTrained:
    def __init__(self, views: list[Logistic], calibrations: list[Logistic], combined: Logistic) -> None:
        self.views, self.calibrations, self.combined = views, calibrations, combined

    @classmethod
    def trained(cls, labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, pseudo: Callable[[list[tuple], list[Logistic]], Sums] | None = None) -> "CoTrained":
        """pseudo(labellers, models) gives, for each view, how many rows the other view's labeller is confident of, and
        the sums of the view's model over them."""
        held = np.arange(len(y)) % 3 == 2
        mine = [(labelled[v][~held], y[~held]) for v in (0, 1)]
        models = [Logistic(x).fit(x, t) for x, t in mine]
        for _ in range(ROUNDS if pseudo else 0):
            labellers = [(m, m.w) for m in models]
            for _ in range(STEPS):
                change = 0.0
                for m, (x, t), (n, g, h) in zip(models, mine, pseudo(labellers, models), strict=True):
                    weight = min(1.0, len(t) / n) if n else 0.0
                    own = m.sums(x, t)
                    change = max(change, m.step(own[0] + weight * g, own[1] + weight * h))
                if change < 1e-4:
                    break
        logits = [models[v].logit(labelled[v][held]) for v in (0, 1)]
        calibrations = [Logistic(z[:, None], 0.1).fit(z[:, None], y[held]) for z in logits]
        both = np.c_[tuple(np.clip(c.logit(z[:, None]), -12, 12) for c, z in zip(calibrations, logits, strict=True))]
        return cls(models, calibrations, Logistic(both, 0.1).fit(both, y[held]))

    def scores(self, views: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = [np.clip(self.calibrations[v].logit(self.views[v].logit(views[v])[:, None]), -12, 12) for v in (0, 1)]
        return _p(z[0]), _p(z[1]), _p(self.combined.logit(np.c_[tuple(z)]))


def pseudo_sums(views: tuple[np.ndarray, np.ndarray], labellers: list[tuple], models: list[Logistic]) -> Sums:
    """CoTrained.trained()'s sums over rows in memory."""
    out = []
    for v in (0, 1):
        labeller, w = labellers[1 - v]
        p = _p(labeller.design(views[1 - v]) @ w)
        sure = (p >= CONFIDENT) | (p <= 1 - CONFIDENT)
        out.append((float(sure.sum()), *models[v].sums(views[v][sure], (p[sure] > 0.5).astype(float))))
    return out


def _flat(sums: Sums) -> np.ndarray:
    return np.concatenate([np.r_[n, g, h[np.triu_indices(len(g))]] for n, g, h in sums])


def _unflat(x: np.ndarray, sizes: list[int]) -> Sums:
    out, at = [], 0
    for k in sizes:
        upper = np.triu_indices(k)
        h = np.zeros((k, k))
        h[upper] = x[at + 1 + k : at + 1 + k + len(upper[0])]
        out.append((x[at], x[at + 1 : at + 1 + k], h + h.T - np.diag(np.diag(h))))
        at += 1 + k + len(upper[0])
    return out


def _over_table(pool: DataFrame) -> Callable[[list[tuple], list[Logistic]], Sums]:
    """pseudo_sums() over a table of features: a task adds up its rows, Spark the tasks' sums (exactly, in any order)."""

    def sums(labellers: list[tuple], models: list[Logistic]) -> Sums:
        def run(batches):
            total = 0.0
            for b in batches:
                if b.num_rows:
                    total = total + _flat(pseudo_sums((_matrix(b.column("content").to_pylist()), _matrix(b.column("metadata").to_pylist())), labellers, models))
            if np.ndim(total):
                yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(total)), pa.int32()), "x": pa.array(total)})

        sizes = [len(m.w) for m in models]
        x = np.zeros(sum(1 + k + k * (k + 1) // 2 for k in sizes))
        for at, value in pool.mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,10)"))).collect():  # a value for each pair of features
            x[at] = float(value)
        return _unflat(x, sizes)

    return sums


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> CoTrained | None:
    """The model, or None if there are no labels of both values."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    chosen = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled), "labelled")
    cols = _columns(docs, "doc_id")
    mine = cols.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min_by(F.struct(*GIVEN), F.struct(F.xxhash64("text"), F.xxhash64("lang", "source", "n_chars"))).alias("x"))
    rows = _featured(mine.select("doc_id", "quality", "x.*")).toPandas()
    rows = rows.iloc[sorted(range(len(rows)), key=lambda i: (xxhash.xxh64_intdigest(str(rows["doc_id"].iloc[i])), rows["doc_id"].iloc[i]))]
    y = (rows["quality"].to_numpy() >= 1).astype(float)
    held = np.arange(len(y)) % 3 == 2
    if len(y) < 6 or min(n for some in (y, y[held], y[~held]) for n in (some.sum(), (1 - some).sum())) < 1:
        return None
    pool = written(_featured(_columns(cols.join(F.broadcast(chosen), "doc_id", "left_anti"))), "features")
    model = CoTrained.trained((_matrix(rows["content"].tolist()), _matrix(rows["metadata"].tolist())), y, _over_table(pool))
    discard(pool)
    discard(chosen)
    return model


def scored(docs: DataFrame, model: CoTrained | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, p_content, p_metadata, score and keep (score >= threshold) of every document."""

    def start():
        def make(*columns: list) -> dict:
            p = np.ones((3, len(columns[0]))) if model is None else np.round(model.scores(_views(*columns)), 6)
            return {"p_content": p[0], "p_metadata": p[1], "score": p[2], "keep": p[2] >= threshold}

        return make

    return map_rows(_columns(docs, "doc_id"), GIVEN, start, "p_content double, p_metadata double, score double, keep boolean")


def kept(docs: DataFrame, model: CoTrained | None, threshold: float = THRESHOLD) -> DataFrame:
    """docs' rows, with all their columns, that the model does not reject."""

    @F.pandas_udf("boolean")
    def good(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.Series:
        if model is None or not len(text):
            return pd.Series(np.ones(len(text), bool))
        return pd.Series(model.scores(_views(*(x.astype(object).where(x.notna(), None).tolist() for x in (text, lang, source, n_chars))))[2].round(6) >= threshold)

    return docs.where(good("text", "lang", "source", F.col("n_chars").cast("double")))
