"""Quality classification by co-training two views of a document.

One view is the text's content: the shapes of its words, how often they repeat, its function words. The other
is the metadata of the page: language, source, length and line layout. Each has a logistic regression. In
rounds, each classifier labels those of all unlabelled documents that it is most sure of, and these join
the other's training rows. At the end each view is calibrated on labelled rows that it was not trained on, and the
calibrated log-odds of the views, added and calibrated once more, score all documents.

Labelled rows are a bounded sample, chosen by a hash of the id. The features of the other documents, once per id, are
kept in the shared folder. Each round takes their scores' histogram, whose tails give the thresholds, and
fits by gradients and Hessians summed over partitions, so every confident document counts and the driver holds
only sums. Every document is scored at the end, in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import settled, texts
from tidemark.llm.quality_rules import STOP_WORDS

SHAPES, SOURCES, LANGS = 192, 16, 8
_STOP = frozenset(w.encode() for w in STOP_WORDS)
_RUNS = re.compile(rb"([a-z\x80-\xff]+)|([A-Z]+)|([0-9]+)|([^a-zA-Z0-9\x80-\xff])\4*")


@dataclass(frozen=True)
class Plan:
    """``labelled`` rows at most; per round ``share`` of the unlabelled documents is taken from either end, if ``sure``."""

    labelled: int = 3000
    rounds: int = 4
    share: float = 0.05
    sure: float = 0.95
    ridge: float = 1e-2
    keep: float = 0.5


class _Shapes(dict):
    """Word -> place of its shape: runs of small, great letters and digits count as one, signs stand for themselves."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        shape = _RUNS.sub(lambda m: b"a" if m[1] else b"A" if m[2] else b"0" if m[3] else m[4], word)
        place = self[word] = xxhash.xxh32_intdigest(shape) % SHAPES
        return place


_SHAPES = _Shapes()


def content(text: str) -> np.ndarray:
    """Features of the text-content view."""
    words = text.encode().split()
    n = max(1, len(words))
    shapes = np.bincount(np.fromiter(map(_SHAPES.__getitem__, words), np.int64, len(words)), minlength=SHAPES) / n
    again = 1 - len(set(zip(words, words[1:]))) / max(1, len(words) - 1) if len(words) > 1 else 0.0
    stop = sum(w in _STOP for w in words) / n
    return np.concatenate([np.sqrt(shapes), [again, 1 - len(set(words)) / n, stop, len(b"".join(words)) / n / 10, np.log1p(len(words)) / 10]])


def page(text: str, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Features of the page-metadata view; a missing value has its own place."""
    out = np.zeros(LANGS + SOURCES + 6)
    out[0 if lang is None else 1 + xxhash.xxh32_intdigest(lang) % (LANGS - 1)] = 1
    out[LANGS + (0 if source is None else 1 + xxhash.xxh32_intdigest(source) % (SOURCES - 1))] = 1
    lines = [x for x in text.split("\n") if x]
    size = np.array([len(x) for x in lines]) if lines else np.zeros(1)
    out[-6:] = [
        np.log1p(n_chars if n_chars is not None else len(text)) / 10, np.log1p(len(lines)) / 5, np.log1p(size.mean()) / 10,
        size.std() / (1 + size.mean()), sum(x[-1] in ".!?" for x in lines) / max(1, len(lines)), text.count(" ") / max(1, len(text)) * 5]
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float, weight: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.ones(len(x)) if weight is None else weight
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge * len(x) / 10)
    penalty[-1] = 1e-6
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


@dataclass(frozen=True)
class Round:
    """Of each view, its weights, and the log-odds up to which and from which it labels documents for the other."""

    weights: tuple[np.ndarray, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]


def taken(views: list[np.ndarray], rounds: list[Round]) -> list[np.ndarray]:
    """Labels that each view has got from the other so far; -1 where none. The first label stays."""
    out = [np.full(len(views[0]), -1) for _ in views]
    for r in rounds:
        for teacher, pupil in ((0, 1), (1, 0)):
            odds = logit(views[teacher], r.weights[teacher])
            got = np.where(odds <= r.low[teacher], 0, np.where(odds >= r.high[teacher], 1, -1))
            out[pupil] = np.where(out[pupil] < 0, got, out[pupil])
    return out


def sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number of rows, gradient and Hessian of the logistic loss, in one array."""
    x = np.hstack([x, np.ones((len(x), 1))])
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return np.concatenate([[len(x)], x.T @ (p - y), ((x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x).ravel()])


_BINS = 6001  # of log-odds from -30 to 30


def _places(odds: np.ndarray) -> np.ndarray:
    return np.rint((odds + 30) * 100).astype(np.int64)


def _total(pool: DataFrame, measure: Callable[[list[np.ndarray]], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``measure`` of the two views over all rows, first by partition, then by a few tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += measure([np.frombuffer(b"".join(batch.column(c).to_pylist()), "<f4").reshape(batch.num_rows, -1).astype(float) for c in "ab"])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for part in batch.column("total"):
                total += np.frombuffer(part.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    parts = pool.select("a", "b").mapInArrow(run, "total binary").repartition(8).mapInArrow(add, "total binary").toArrow()
    return sum((np.frombuffer(x.as_py()) for x in parts.column("total")), np.zeros(size))


def _tails(counts: np.ndarray, take: int, sure: float) -> tuple[float, float]:
    """The log-odds that cut ``take`` rows off either end, no further in than ``sure``; rows of a bin go together."""
    edge = np.log(sure / (1 - sure))
    low = min(int(np.searchsorted(counts.cumsum(), take)), _BINS - 1)
    high = _BINS - 1 - min(int(np.searchsorted(counts[::-1].cumsum(), take)), _BINS - 1)
    return min(-edge, (low + 0.5) / 100 - 30), max(edge, (high - 0.5) / 100 - 30)


def _refit(rows: list[tuple[np.ndarray, np.ndarray]], weights: list[np.ndarray], pool: DataFrame, rounds: list[Round], plan: Plan) -> list[np.ndarray]:
    """Newton steps of both views at once, over the labelled rows and all documents taken."""
    weights, ends = list(weights), np.cumsum([1 + len(w) + len(w) ** 2 for w in weights])
    for _ in range(12):
        now = tuple(weights)

        def measure(views: list[np.ndarray], now: tuple[np.ndarray, ...] = now) -> np.ndarray:
            return np.concatenate([sums(v[t >= 0], t[t >= 0], w) for v, t, w in zip(views, taken(views, rounds), now)])

        total, largest = np.split(_total(pool, measure, int(ends[-1])), ends[:-1]), 0.0
        for k, (part, (x, y)) in enumerate(zip(total, rows)):
            part, n = part + sums(x, y, weights[k]), len(weights[k])
            penalty = np.full(n, plan.ridge * part[0] / 10)
            penalty[-1] = 1e-6
            step = np.linalg.solve(part[1 + n:].reshape(n, n) + np.diag(penalty), part[1:1 + n] + penalty * weights[k])
            weights[k] = weights[k] - step
            largest = max(largest, np.abs(step).max())
        if largest < 1e-4:
            break
    return weights


def cotrained(views: list[np.ndarray], y: np.ndarray, pool: DataFrame, plan: Plan) -> tuple[list[np.ndarray], np.ndarray]:
    """Weights of each view, and calibration: a slope for each view and a constant."""
    if len(np.unique(y)) < 2:  # nothing to tell apart: every document gets the share of good ones
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return [np.zeros(v.shape[1] + 1) for v in views], np.array([0.0] * len(views) + [np.log(share / (1 - share))])
    held = np.arange(len(y)) % 4 == 3
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        held = np.zeros(len(y), bool)
    rows = [(v[~held], y[~held].astype(float)) for v in views]
    weights = [fit(x, t, plan.ridge) for x, t in rows]
    take = max(1, int(plan.share * size)) if (size := pool.count()) else 0
    rounds: list[Round] = []
    for _ in range(plan.rounds if size else 0):
        now = tuple(weights)

        def measure(features: list[np.ndarray], now: tuple[np.ndarray, ...] = now, before: tuple[Round, ...] = tuple(rounds)) -> np.ndarray:
            free = taken(features, list(before))[::-1]  # of a teacher's pupil
            return np.concatenate([np.bincount(_places(logit(v, w))[f < 0], minlength=_BINS) for v, w, f in zip(features, now, free)]).astype(float)

        ends = [_tails(c, take, plan.sure) for c in np.split(_total(pool, measure, 2 * _BINS), 2)]
        rounds.append(Round(now, *map(tuple, zip(*ends))))
        weights = _refit(rows, weights, pool, rounds, plan)
    on = held if held.any() else ~held
    return weights, fit(np.stack([logit(v[on], w) for v, w in zip(views, weights)], axis=1), y[on].astype(float), 1e-3)


def _features(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    values = [rows.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars")]
    return np.array([content(t) for t in values[0]]), np.array([page(*v) for v in zip(*values)])


def _sample(docs: DataFrame, labels: DataFrame, plan: Plan) -> tuple[list[np.ndarray], np.ndarray, DataFrame]:
    """Features and labels of the sample of labelled rows, and the features of all other documents; one row for each id."""
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("y"))
    # At most ``labelled`` ids, so they can be broadcast.
    some = good.orderBy(F.xxhash64("doc_id", F.lit(1))).limit(plan.labelled).select(F.col("doc_id").alias("c"), F.col("y").cast("int").alias("y"))
    rows = docs.where("doc_id is not null").join(F.broadcast(some), F.col("doc_id") == F.col("c"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                a, b = ([x.tobytes() for x in v.astype("<f4")] for v in _features(part))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["doc_id", "y", "a", "b"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"doc_id {id_type}, y int, a binary, b binary")
    every = settled(made.groupBy("doc_id").agg(F.min(F.struct("a", "b", "y")).alias("f")).select("doc_id", "f.*"))
    got = every.where("y is not null").toArrow().sort_by("doc_id").to_pydict()
    wide = (len(content("")), len(page("", None, None, None)))
    views = [np.frombuffer(b"".join(got[k]), "<f4").astype(float).reshape(-1, n) for k, n in zip("ab", wide)]
    return views, np.array(got["y"]), every.where("y is null")


def score(docs: DataFrame, labels: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``doc_id``, ``p_content``, ``p_page``, ``score`` (probability of good quality) and ``kept`` for each row.

    A null text counts as empty; null metadata has a place of its own. Labels without id or quality are left
    out, of several for one id the lowest counts. Without labels of both kinds every document gets the
    share of good ones. Repeated rows each get their row; an empty table gives an empty result.
    """
    rows = texts(docs, "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
    views, y, pool = _sample(rows, labels, plan)
    weights, calibration = cotrained(views, y, pool, plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                odds = [logit(x, w) for x, w in zip(_features(part), weights)]
                total = sum(o * c for o, c in zip(odds, calibration)) + calibration[-1]
                p = [1 / (1 + np.exp(-np.clip(o, -30, 30))) for o in (*odds, total)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, p), pa.array(p[2] >= plan.keep)], ["doc_id", "p_content", "p_page", "score", "kept"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, p_content double, p_page double, score double, kept boolean")
