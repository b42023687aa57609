"""Quality classifier by co-training: one classifier sees the text, the other what is known about the document.

Each round both are fitted on their labelled documents, and each gives the other the unlabelled ones it is surest of,
with the labels it thinks they have. Their scores are then calibrated on labelled documents that neither was fitted on,
and the two calibrated views are combined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_share, only_own, ship, stored, text_batches

BITS = 11
GRAMS = 1 << BITS
MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
SHAPES = 6
NAMES = 64
SLICE = 1 << 20


def text_features(text: str | None) -> np.ndarray:
    """Normalised counts of hashed case-sensitive letter triples of the whole text, and the shape of its words.

    Shape: share of capitals, of signs, of distinct words, mean length of words, few words, no words.
    """
    text = text or ""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.zeros(GRAMS, np.int64)
    for start in range(0, len(points) - 2, SLICE):
        a = points[start : start + SLICE + 2]
        mixed = (a[:-2] * MIX[0] + a[1:-1] * MIX[1] + a[2:] * MIX[2]) * MIX[1]
        counts += np.bincount(mixed >> np.uint32(32 - BITS), minlength=GRAMS)
    grams = np.sqrt(counts)
    words = text.split()
    n = max(1, len(words))
    letters = max(1, len(points) - 2)
    capitals = int(((points >= 65) & (points <= 90)).sum())
    signs = int(((points > 32) & (points < 48) | (points > 57) & (points < 65) | (points > 90) & (points < 97) | (points > 122) & (points < 127)).sum())
    shape = (
        capitals / letters,
        signs / letters,
        len(set(words)) / n,
        min(letters / n, 30) / 10,
        1 / (1 + len(words)),
        float(not words),
    )
    return np.concatenate([grams / max(1e-9, float(np.linalg.norm(grams))), shape]).astype(np.float32)


def slot(name: str | None, salt: int) -> int:
    value = salt
    for byte in (name or "").encode("utf-8", "surrogatepass"):
        value = (value * 131 + byte) % 1_000_003
    return value % NAMES


def page_features(text: str | None, lang: str | None, source: str | None) -> np.ndarray:
    """Where a document is from, its language, and its length and lines."""
    out = np.zeros(2 * NAMES + 5, np.float32)
    out[slot(source, 1)] = 1
    out[NAMES + slot(lang, 2)] = 1
    text = text or ""
    lines = text.count("\n") + 1
    out[2 * NAMES :] = (
        np.log1p(len(text)) / 10,
        np.log1p(lines) / 5,
        np.log1p(len(text) / lines) / 10,
        float(source is None),
        float(lang is None),
    )
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Logistic:
    """Logistic regression on standardised features, fitted by Newton-free accelerated gradient steps."""

    penalty: float = 1e-3
    steps: int = 120
    mean: np.ndarray = field(default_factory=lambda: np.zeros(1, np.float32))
    scale: np.ndarray = field(default_factory=lambda: np.ones(1, np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1, np.float32))
    bias: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        """Both classes count alike, however rare one is."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = (x - self.mean) / self.scale
        share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
        z = np.concatenate([z, np.ones((len(z), 1))], axis=1, dtype=np.float32)
        share = share.astype(np.float32)
        bound = float((share * (z * z).sum(axis=1)).sum()) / 4 + self.penalty
        w = ahead = np.zeros(z.shape[1], np.float32)
        for k in range(self.steps):
            slope = z.T @ (share * (sigmoid(z @ ahead) - y)) + self.penalty * np.append(ahead[:-1], 0)
            new = (ahead - slope / bound).astype(np.float32)
            ahead = (new + k / (k + 3) * (new - w)).astype(np.float32)
            w = new
        self.weights, self.bias = w[:-1].astype(np.float32), float(w[-1])
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias


@dataclass
class QualityModel:
    text_view: Logistic
    page_view: Logistic
    text_scale: tuple[float, float] = (1.0, 0.0)
    page_scale: tuple[float, float] = (1.0, 0.0)
    mixed: tuple[float, float, float] = (0.5, 0.5, 0.0)
    threshold: float = 0.5
    learned: bool = True

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated text view, calibrated page view, both combined."""
        t = self.text_scale[0] * self.text_view.margin(text) + self.text_scale[1]
        p = self.page_scale[0] * self.page_view.margin(page) + self.page_scale[1]
        a, b, c = self.mixed
        return sigmoid(t), sigmoid(p), sigmoid(a * t + b * p + c)


def calibrated(columns: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Weights and bias that turn margins into chances: logistic regression on a few columns, smoothed labels."""
    good, bad = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.concatenate([columns, np.ones((len(columns), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ w)
        slope = x.T @ (p - target) / len(x) + penalty * np.append(w[:-1], 0)
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(x) + np.eye(len(w)) * (penalty + 1e-9)
        w = w - np.linalg.solve(curve, slope)
    return w


def co_train(
    text: np.ndarray, page: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_page: np.ndarray, rounds: int, share: float, sure: float
) -> tuple[Logistic, Logistic]:
    """The two classifiers after so many rounds; each round a ``share`` of the pool per view, if at least ``sure``."""
    own = {"text": [(text, y)], "page": [(page, y)]}
    left = np.arange(len(pool_text))
    for turn in range(rounds + 1):
        views = {}
        for view, parts in own.items():
            views[view] = Logistic().fit(np.concatenate([x for x, _ in parts]), np.concatenate([t for _, t in parts]))
        if turn == rounds or not len(left):
            break
        taken = np.zeros(len(left), bool)
        for view, other, mine, theirs in (("text", "page", pool_text, pool_page), ("page", "text", pool_page, pool_text)):
            chance = sigmoid(views[view].margin(mine[left]))
            certain = np.abs(chance - 0.5)
            # Surest first, the same number for both labels where there are as many.
            for label in (0, 1):
                fit = (chance >= 0.5) == bool(label)
                order = np.argsort(np.where(fit, -certain, 1), kind="stable")[: max(1, int(share * len(pool_text)))]
                order = order[fit[order] & (certain[order] >= sure - 0.5)]
                own[other].append((theirs[left[order]], np.full(len(order), label)))
                taken[order] = True
        left = left[~taken]
    return views["text"], views["page"]


def fit(
    documents: DataFrame,
    labels: DataFrame,
    labelled_rows: int = 2400,
    pool_rows: int = 2000,
    rounds: int = 4,
    share: float = 0.05,
    sure: float = 0.9,
    keep_clean: float = 0.998,
) -> QualityModel:
    """Learn from ``labels`` (doc_id, quality) of ``documents`` (doc_id, text, lang, source).

    The model is fitted on bounded samples: about ``labelled_rows`` labelled documents (two thirds to fit, one third to
    calibrate) and about ``pool_rows`` others for the exchange, both chosen by a hash of doc_id; what reaches the driver
    is one feature row for each. The threshold is half the score that ``keep_clean`` of the good calibration documents reach. Labels
    without a value are left out and repeated ones averaged. Of rows with one doc_id the first in order is learned from,
    of those without one none, so neither can fill the samples. With fewer than two kinds of label nothing is learned
    and every document is kept.
    """
    ship(documents.sparkSession)
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("label")
    )
    known = stored(known, "quality-labels")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return QualityModel(Logistic(), Logistic(), learned=False)
    # As many of the rarer kind as there are, up to half.
    rates = {k: min(1.0, labelled_rows / 2 / n) for k, n in counts.items()}
    rate = F.when(F.col("label") == 1, F.lit(rates[1])).otherwise(F.lit(rates[0]))
    chosen = stored(known.where(hash_share("doc_id") < rate), "quality-chosen")
    rows = documents.select("doc_id", "text", "lang", "source").where(F.col("doc_id").isNotNull())
    total = rows.count()
    pool = rows.where(hash_share("doc_id", F.lit("pool")) < min(1.0, pool_rows / max(1, total)))
    pool = pool.join(known.select("doc_id"), "doc_id", "left_anti").withColumn("label", F.lit(-1))
    sample = rows.join(chosen, "doc_id").unionByName(pool)
    sample = sample.groupBy("doc_id").agg(F.min(F.struct("label", "text", "lang", "source")).alias("r")).select("doc_id", "r.*")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_own()
        for batch, texts in text_batches(batches, "text"):
            lang, source = (batch.column(c).to_pylist() for c in ("lang", "source"))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "label": batch.column("label"),
                    "x": pa.array([text_features(t).astype("<f2").tobytes() for t in texts], pa.binary()),
                    "p": pa.array([page_features(*v).astype("<f4").tobytes() for v in zip(texts, lang, source)], pa.binary()),
                }
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    found = sample.mapInArrow(measured, f"doc_id {kind}, label int, x binary, p binary").collect()
    found.sort(key=lambda r: (str(r["doc_id"]), r["x"], r["p"]))
    if not found:
        return QualityModel(Logistic(), Logistic(), learned=False)
    x = np.stack([np.frombuffer(r["x"], "<f2") for r in found]).astype(np.float32)
    p = np.stack([np.frombuffer(r["p"], "<f4") for r in found])
    y = np.array([r["label"] for r in found])
    order = np.random.default_rng(7).permutation(len(found))
    own = order[y[order] >= 0]
    cut = len(own) * 2 // 3
    train, calibration, free = own[:cut], own[cut:], order[y[order] < 0]
    if len(set(y[train])) < 2 or len(set(y[calibration])) < 2:
        train = calibration = own
        if len(set(y[own])) < 2:
            return QualityModel(Logistic(), Logistic(), learned=False)
    text_view, page_view = co_train(x[train], p[train], y[train], x[free], p[free], rounds, share, sure)
    model = QualityModel(text_view, page_view)
    yc = y[calibration]
    t, g = text_view.margin(x[calibration]), page_view.margin(p[calibration])
    model.text_scale = tuple(calibrated(t[:, None], yc))
    model.page_scale = tuple(calibrated(g[:, None], yc))
    both = np.stack([model.text_scale[0] * t + model.text_scale[1], model.page_scale[0] * g + model.page_scale[1]], axis=1)
    model.mixed = tuple(calibrated(both, yc))
    good = model.scores(x[calibration], p[calibration])[2][yc == 1]
    model.threshold = min(0.5, float(np.quantile(good, 1 - keep_clean)) / 2)
    return model


def scored(model: QualityModel, text: Column, lang: Column, source: Column) -> Column:
    """A struct (text_score, page_score, score, kept) for each document; nulls count as empty values.

    A model that learned nothing scores 1 and keeps all.
    """

    @F.pandas_udf("text_score double, page_score double, score double, kept boolean")
    def score(texts: pd.Series, langs: pd.Series, sources: pd.Series) -> pd.DataFrame:
        only_own()
        rows = list(zip(texts.tolist(), langs.tolist(), sources.tolist()))
        parts = []
        for i in range(0, len(rows), 256):
            some = rows[i : i + 256]
            if model.learned:
                found = model.scores(np.stack([text_features(r[0]) for r in some]), np.stack([page_features(*r) for r in some]))
                parts.append(np.stack(found, axis=1))
            else:
                parts.append(np.ones((len(some), 3)))
        values = np.concatenate(parts) if parts else np.zeros((0, 3))
        out = pd.DataFrame(values.astype(float), columns=["text_score", "page_score", "score"])
        out["kept"] = out["score"] >= model.threshold
        return out

    return score(text, lang, source)
