"""Text quality by Bradley-Terry ranking.

Pairs of one preferred and one rejected labelled text are drawn, and the log odds that the
first wins are linear in the difference of their features; weights minimise the logistic
loss (Newton's method, L2 penalty). A text's ranking score is its own linear term. The
threshold is the quantile of the labelled texts' scores that parts the labels best, and the
score reported is the logistic function of the scaled distance to it.

Features come from the text alone: byte classes, word and line statistics.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.encode import forget
from harvestry.session import ship_package

#: Labelled rows the model is fitted on at most (chosen by a hash of the id), and pairs drawn.
SAMPLE_ROWS, PAIRS, PENALTY = 20_000, 60_000, 1e-3

CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz",
           "digit": b"0123456789", "stop": b".", "comma": b",;:", "shout": b"!?", "bar": b"|",
           "sign": b"#$%&*@^~_=+<>\\/", "bracket": b"()[]{}\"'`-", "space": b" \t\r\x0b\x0c",
           "line": b"\n"}
TABLE = np.zeros((256, len(CLASSES) + 1))
for place, members in enumerate(CLASSES.values()):
    TABLE[list(members), place] = 1
TABLE[128:, -1] = 1
#: Where the features hold the logarithm of the number of words.
WORDS = len(CLASSES) + 3


def features(text: str) -> list[float]:
    """Features of a whole text; an empty text gives zeros but for the bias-free defaults."""
    raw = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ TABLE
    total = max(len(raw), 1)
    words = raw.split()
    n = max(len(words), 1)
    distinct = Counter(words)
    most = distinct.most_common(1)[0][1] if words else 0
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = counts[0] + counts[1] + counts[-1]
    again = sum(map(eq, words, words[1:])) + sum(map(eq, words, words[2:]))
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    mean = float(lengths.mean()) if words else 0.0
    spread = float(lengths.std()) if words else 0.0
    return [*np.sqrt(counts / total), counts[0] / max(letters, 1), math.log1p(len(raw)),
            math.log1p(n), len(distinct) / n, math.log(max(len(distinct), 1)) / math.log(n + 1),
            math.sqrt(most / n), math.sqrt(again / n), math.log1p(mean), math.log1p(spread),
            math.sqrt(1 - len(set(lines)) / max(len(lines), 1)),
            math.log1p(n / max(len(lines), 1)), math.sqrt(min(counts[3] / n, 1)),
            math.sqrt(sum(len(w) < 4 for w in distinct) / max(len(distinct), 1))]


def scaled(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Standard units, drawn towards 0 for texts of few words: their shares say little."""
    words = np.expm1(x[:, WORDS])
    return (x - mean) / spread * np.sqrt(words / (words + 8))[:, None]


@dataclass(frozen=True)
class Model:
    """Ranks are scaled features @ weights; a text passes at the threshold."""
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float

    def rank(self, x: np.ndarray) -> np.ndarray:
        return scaled(x, self.mean, self.spread) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.rank(x) - self.threshold) / self.scale, -30, 30)))


def fit(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Model:
    """Bradley-Terry weights and the threshold; with one label only (or no rows) every text
    scores one half."""
    width = x.shape[1] if x.ndim == 2 else len(features(""))
    better, worse = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not (len(better) and len(worse)):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)
    mean, spread = x[better].mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1
    units = scaled(x, mean, spread)
    rng = np.random.default_rng(seed)
    apart = units[rng.choice(better, pairs)] - units[rng.choice(worse, pairs)]
    weights = np.zeros(width)
    for _ in range(40):
        lost = 1 / (1 + np.exp(np.clip(apart @ weights, -30, 30)))
        slope = -(apart.T @ lost) / pairs + PENALTY * weights
        curve = (apart * (lost * (1 - lost))[:, None]).T @ apart / pairs
        step = np.linalg.solve(curve + PENALTY * np.eye(width), slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    ranks = units @ weights
    levels = np.quantile(ranks, np.linspace(0, 1, 401))
    # Balanced accuracy at each quantile; where several are best, the middle of them.
    high, low = np.sort(ranks[better]), np.sort(ranks[worse])
    kept = 1 - np.searchsorted(high, levels) / len(high)
    dropped = np.searchsorted(low, levels) / len(low)
    best = np.flatnonzero(kept + dropped >= (kept + dropped).max() - 1e-12)
    threshold = float(levels[best].mean())
    return Model(mean, spread, weights, threshold, max(float(ranks.std()) / 4, 1e-9))


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 3 == 1,
                      F.lit(False))


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents outside the held-out third; the driver sees
    their features only. Null labels are passed over."""
    ship_package(documents.sparkSession)
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        F.col("quality").isin(0, 1) & ~is_held_out())
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "text", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.float64())), batch.column(1)],
                names=["x", "label"])

    # Rows that repeat an id could multiply the sample: the bound holds for them as well.
    learnt = texts.mapInArrow(run, "x array<double>, label int").limit(rows).collect()
    learnt.sort(key=lambda r: (r["label"], r["x"]))
    return fit(np.array([r["x"] for r in learnt]), np.array([r["label"] for r in learnt]))


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``score`` and ``predicted``, which replace columns of these names.
    A null text is scored as an empty one."""
    ship_package(documents.sparkSession)
    rest = [name for name in documents.columns if name not in ("score", "predicted")]
    held = documents.select(F.struct(*[F.col(f"`{n}`") for n in rest]).alias("row"), "text")
    schema = held.select("row").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = [features(t or "") for t in batch.column(1).to_pylist()]
            score = model.score(np.array(found)) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64())], names=["row", "score"])

    out = held.mapInArrow(run, schema.add("score", "double"))
    return out.select("row.*", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0)
                      .alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents the classifier does not reject, with their own columns."""
    model = train(documents, labels)
    return scored(documents, model).where("predicted = 1").select(*documents.columns)
