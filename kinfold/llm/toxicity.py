"""Toxic passages as maximum-scoring segments of token log-odds, calibrated by extreme-value statistics.

Training looks at a bounded sample of labelled documents. Words fall into 2^18 bins by their hash; a bin's score
is the log-odds of toxic against other documents with a Dirichlet prior in proportion to the bin's frequency
(Monroe, Colaresi and Quinn), taken back by its own uncertainty and by a small cost per word. The scan of Ruzzo and Tompa
finds all maximal segments of a text in linear time. Karlin and Altschul's statistics say how often a segment of
such a score comes up by chance in a text of that length; the best segment, the sum of the
significant ones and their number then give the probability, fitted on documents the log-odds have not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.words import ALPHANUMERIC, Words, word_groups

BINS = 18
SAMPLE = 100_000
PRIOR = 500.0
DOUBT = 1.64
WORD_COST = 0.05
SIGNIFICANT = 1.0
WEIGHT_FOLDS, CALIBRATION_FOLD, HELD_OUT_FOLD = (0, 1), 3, 2
PASSAGES = "array<struct<start: int, end: int, score: double, e_value: double>>"


@dataclass
class Model:
    """Scores of the bins, the two constants of the extreme-value law, and the calibration of the features."""

    scores: np.ndarray
    rate: float
    log_k: float
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def fold() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))


def labelled_sample(labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """At most ``most`` labelled ids outside the held-out fold: those with the least hashes, 12 bytes each.

    Rows without id or label are left out; of several labels of a document the highest counts.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.withColumn("fold", fold().cast("int")).filter(F.col("fold") != HELD_OUT_FOLD).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", F.col("toxic").cast("int").alias("toxic"), "fold")


def _bins(group: Words) -> np.ndarray:
    return (group.hashes() >> np.uint64(64 - BINS)).astype(np.int64)


def _count(batches):
    """Documents with a word of each bin, toxic and other, and words in other documents."""
    counts = np.zeros((3, 1 << BINS), np.int64)
    texts = np.zeros(2, np.int64)
    for batch in batches:
        toxic = np.asarray(batch.column("toxic").to_pylist(), np.int64) > 0
        for group in word_groups(batch.column("text"), ALPHANUMERIC, lower=True):
            bins = _bins(group)
            for i in range(len(group.first) - 1):
                own = bins[group.first[i]:group.first[i + 1]]
                bad = bool(toxic[group.low + i])
                texts[0 if bad else 1] += 1
                counts[0 if bad else 1, np.unique(own)] += 1
                if not bad:
                    np.add.at(counts[2], own, 1)
    used = np.flatnonzero(counts.any(axis=0))
    # The numbers of texts go along as the last bin.
    yield pa.RecordBatch.from_arrays(
        [pa.array([*used, 1 << BINS], pa.int32()), *[pa.array([*counts[k, used], n], pa.int64()) for k, n in enumerate([*texts, 0])]],
        ["bin", "toxic", "other", "words"])


def bin_scores(counts: np.ndarray, texts: tuple[int, int]) -> np.ndarray:
    """Log-odds of each bin from its (toxic, other) document counts, shrunk to 0 by their uncertainty."""
    toxic, other = counts.astype(float)
    n_toxic, n_other = texts
    prior = PRIOR * (toxic + other) / max(1, n_toxic + n_other) + 1e-3
    odds = lambda k, n: np.log((k + prior) / (n + PRIOR - np.minimum(k + prior, n + PRIOR - 1)))
    difference = odds(toxic, n_toxic) - odds(other, n_other)
    doubt = DOUBT * np.sqrt(1 / (toxic + prior) + 1 / (other + prior))
    return np.sign(difference) * np.maximum(0, np.abs(difference) - doubt) - WORD_COST


def decay_rate(scores: np.ndarray, words: np.ndarray) -> float:
    """The positive rate at which the mean of exp(rate * score) is 1 over ordinary words (Karlin and Altschul).

    Bins with a positive score count as seen half a time more, since what was not seen yet may still come.
    """
    words = words + 0.5 * (scores > 0)
    share = words / max(1, words.sum())
    mean = lambda rate: float((share * np.exp(np.minimum(rate * scores, 50))).sum())
    low, high = 0.0, 1.0
    if not ((share > 0) & (scores > 0)).any() or (share * scores).sum() >= 0:
        return 1.0
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return max(high, 1e-3)


def maximal_segments(before: list[float], after: list[float]) -> list[tuple[int, int, float]]:
    """Ruzzo and Tompa's scan over the positive places of a text, given the running sums before and after each.

    Gives (first, last, score) of every maximal segment; places between them only lower the sum. Every place
    is taken on and off the stack once.
    """
    done: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum after
    left: list[int] = []  # of each segment on the stack: the nearest earlier one with a lower sum before, or -1
    for i, (low, high) in enumerate(zip(before, after)):
        first = i
        while True:
            j = len(done) - 1
            while j >= 0 and done[j][2] >= low:
                j = left[j]
            if j < 0 or done[j][3] >= high:
                break
            first, low = done[j][0], done[j][2]
            del done[j:], left[j:]
        done.append((first, i, low, high))
        left.append(j)
    return [(a, b, high - low) for a, b, low, high in done]


def _segments(group: Words, scores: np.ndarray):
    """Per text of a group: its words, and its maximal segments as (first word, last word, score)."""
    worth = scores[_bins(group)]
    total = np.concatenate([[0.0], np.cumsum(worth)])
    places = np.flatnonzero(worth > 0)
    bounds = np.searchsorted(places, group.first)
    for i in range(len(group.first) - 1):
        own = places[bounds[i]:bounds[i + 1]]
        found = maximal_segments(total[own].tolist(), total[own + 1].tolist()) if len(own) else []
        yield int(group.first[i + 1] - group.first[i]), [(int(own[a]), int(own[b]), s) for a, b, s in found]


def _features(words: int, segments, rate: float, log_k: float) -> tuple[float, float, float]:
    """Bits of the best segment beyond chance, of all significant ones together, and the number of these."""
    if not segments:
        return 0.0, 0.0, 0.0
    bits = [float(np.logaddexp(0, rate * s - log_k - np.log(max(words, 1)))) for _, _, s in segments]
    return float(np.log1p(max(bits))), float(np.log1p(sum(bits))), float(np.log1p(sum(b > 0.7 for b in bits)))


def _found(batch: pa.RecordBatch, scores: np.ndarray):
    """Words and segments of each text of a batch."""
    for group in word_groups(batch.column("text"), ALPHANUMERIC, lower=True):
        yield from _segments(group, scores)


def _best(batches, scores: np.ndarray, rate: float):
    """Over the task's ordinary texts with a segment: their number, and the sum of how far the best ones lie beyond their lengths."""
    beyond, texts = 0.0, 0
    for batch in batches:
        for toxic, (n, segments) in zip(batch.column("toxic").to_pylist(), _found(batch, scores)):
            if segments and not toxic:
                beyond += rate * max(s for _, _, s in segments) - float(np.log(max(n, 1)))
                texts += 1
    yield pa.RecordBatch.from_arrays([pa.array([beyond]), pa.array([texts], pa.int64())], ["beyond", "texts"])


def _calibration(batches, scores: np.ndarray, rate: float, log_k: float):
    """The label and the three features of each calibration text."""
    for batch in batches:
        rows = [_features(n, segments, rate, log_k) for n, segments in _found(batch, scores)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), *[pa.array([r[k] for r in rows], pa.float64()) for k in range(3)]], ["toxic", "best", "all", "number"])


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method on a few features; the first column is 1."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = penalty * np.eye(len(w))
        ridge[0, 0] = 1e-6
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """Fit on at most ``most`` labelled documents; their texts stay on the executors.

    Log-odds come from two folds of ids, the calibration from a third, and a fourth is never looked at. The
    driver gets counts of at most 2^18 bins, and four numbers of each calibration document.
    """
    chosen = docs.select("doc_id", "text").join(F.broadcast(labelled_sample(labels, most)), "doc_id")
    counted = chosen.filter(F.col("fold").isin(*WEIGHT_FOLDS)).select("text", "toxic").mapInArrow(
        _count, "bin int, toxic bigint, other bigint, words bigint").groupBy("bin").agg(
        *[F.sum(c).alias(c) for c in ("toxic", "other", "words")]).toArrow().to_pydict()
    counts = np.zeros((3, (1 << BINS) + 1), np.int64)
    counts[:, counted["bin"]] = [counted["toxic"], counted["other"], counted["words"]]
    scores = bin_scores(counts[:2, :-1], (int(counts[0, -1]), int(counts[1, -1])))
    rate = decay_rate(scores, counts[2, :-1])
    spread = docs.sparkSession.sparkContext.broadcast(scores)
    calibration = chosen.filter(F.col("fold") == CALIBRATION_FOLD).select("text", "toxic")
    # The mean of a Gumbel law gives K from the best segments of ordinary texts.
    beyond, texts = calibration.mapInArrow(lambda batches: _best(batches, spread.value, rate), "beyond double, texts bigint").agg(
        F.coalesce(F.sum("beyond"), F.lit(0.0)), F.coalesce(F.sum("texts"), F.lit(0))).head()
    log_k = float(beyond / texts - np.euler_gamma) if texts else 0.0
    rows = calibration.mapInArrow(lambda batches: _calibration(batches, spread.value, rate, log_k),
                                  "toxic int, best double, all double, number double").collect()
    x = np.array([(r.best, r["all"], r.number) for r in rows] or [(0.0, 0.0, 0.0)])
    y = np.array([float(r.toxic > 0) for r in rows] or [0.0])
    center, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    weights = _logistic(np.column_stack([np.ones(len(x)), (x - center) / scale]), y)
    return Model(scores, rate, log_k, center, scale, weights)


def _score(batches, model: Model):
    for batch in batches:
        found_scores, passages = [], []
        for group in word_groups(batch.column("text"), ALPHANUMERIC, lower=True):
            points = None
            for i, (n, segments) in enumerate(_segments(group, model.scores)):
                x = (np.array(_features(n, segments, model.rate, model.log_k)) - model.center) / model.scale
                found_scores.append(float(1 / (1 + np.exp(-np.clip(model.weights[0] + x @ model.weights[1:], -30, 30)))))
                own = []
                for a, b, s in segments:
                    expected = float(np.exp(np.clip(model.log_k + np.log(max(n, 1)) - model.rate * s, -700, 700)))
                    if expected < SIGNIFICANT:
                        if points is None:
                            points = np.concatenate([[0], np.cumsum((group.data & 0xC0) != 0x80)])
                        origin = points[group.text_start[i]]
                        own.append({"start": int(points[group.start[a]] - origin), "end": int(points[group.end[b]] - origin),
                                    "score": s, "e_value": expected})
                passages.append(own)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found_scores, pa.float64()), pa.array(passages, kind)],
                                         ["doc_id", "score", "passages"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (probability of being toxic) and passages of every row; only the text is looked at.

    passages are the segments less than ``SIGNIFICANT`` of which are expected by chance in a text of that length, in code
    points, ends exclusive. A null text or one without words has no segments and the score of such texts.
    Repeated rows each get their row; an empty table gives no rows, and without labels every score is one half or less.
    """
    spread = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _score(batches, spread.value),
                                                    f"doc_id bigint, score double, passages {PASSAGES}")
