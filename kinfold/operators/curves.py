"""ROC and precision-recall curves of bounded length, for scores with too many distinct values to keep a point for each.

Scores are cut at approximate quantiles of both classes, and each bin keeps the weight of both classes and its least and greatest
score. Bins with the same bounds can be added up, so a curve can be put together from parts. A bin with one score is exact; within
any other the order is unknown, and the curve lies in the rectangle between the bin's two ends. So the area is known
up to half of those rectangles (of those between the extreme precisions for the precision-recall curve), which comes with the curve.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions.missing import ratio
from kinfold.operators.evaluate import MODEL, usable
from kinfold.session import cut_lineage

ERROR = 1e-3
MOST_BINS = 1 << 17
# Bins that a task holds before it gives them away.
HELD_BINS = 1 << 21


def curve_bounds(predictions: DataFrame, bins: int) -> DataFrame:
    """One row per model: scores that cut each class into about ``bins`` equal parts; at most ``2 * bins`` of them."""
    points = [i / bins for i in range(1, bins)] or [0.5]
    score = F.col("y_prob").cast("double")
    cut = lambda label: F.coalesce(F.percentile_approx(
        F.when(F.col("y_true") == label, score), points, 10 * bins), F.array().cast("array<double>"))
    rows = usable(predictions).filter("y_prob IS NOT NULL")
    both = rows.groupBy(MODEL).agg(cut(1).alias("a"), cut(0).alias("b"))
    return both.select(MODEL, F.array_sort(F.array_distinct(F.concat("a", "b"))).alias("bounds"))


def _binned(batches, bounds: dict[str | None, np.ndarray]):
    """Weights, least and greatest score of the bins a task has met; given away early when they have become many."""
    held: dict[str | None, list[np.ndarray]] = {}

    def away():
        for model, (pos, neg, low, high) in held.items():
            some = np.flatnonzero(np.isfinite(low))
            yield pa.RecordBatch.from_arrays(
                [pa.array([model] * len(some), pa.string()), pa.array(some, pa.int32()), *[pa.array(v[some]) for v in (low, high, pos, neg)]],
                ["model_name", "bin", "low", "high", "pos", "neg"])
        held.clear()

    for batch in batches:
        models, score, weight = batch.column(0).dictionary_encode(), *(np.asarray(batch.column(i)) for i in (1, 3))
        positive = np.asarray(batch.column(2)) == 1
        names = models.dictionary.to_pylist()
        which = np.asarray(models.indices.fill_null(len(names)))
        for k, model in enumerate([*names, None]):
            rows = which == k
            if not rows.any():
                continue
            cut = bounds[model]
            if model not in held:
                n = len(cut) + 1
                held[model] = [np.zeros(n), np.zeros(n), np.full(n, np.inf), np.full(n, -np.inf)]
            pos, neg, low, high = held[model]
            # A score is in the bin that ends with it.
            at = np.searchsorted(cut, score[rows], "left")
            pos += np.bincount(at, weight[rows] * positive[rows], len(pos))
            neg += np.bincount(at, weight[rows] * ~positive[rows], len(neg))
            np.minimum.at(low, at, score[rows])
            np.maximum.at(high, at, score[rows])
        if sum(len(v[0]) for v in held.values()) > HELD_BINS:
            yield from away()
    yield from away()


def curve_bins(predictions: DataFrame, bounds: DataFrame) -> DataFrame:
    """(model_name, bin, low, high, pos, neg): weight of both classes between the bounds, from one pass.

    Tasks add up their own bins; the bounds, two numbers for each part and model, go to every task. Bins of other
    records with the same bounds may be united with these and added up by ``merged_bins``.
    """
    cuts = {r[MODEL]: np.array(r.bounds) for r in bounds.collect()}
    shared = predictions.sparkSession.sparkContext.broadcast(cuts)
    rows = usable(predictions).filter("y_prob IS NOT NULL").select(
        F.col(MODEL).cast("string").alias(MODEL), F.col("y_prob").cast("double").alias("score"), F.col("y_true").cast("int").alias("y_true"),
        F.coalesce(F.col("weight").cast("double"), F.lit(1.0)).alias("weight"))
    return merged_bins(rows.mapInArrow(
        lambda batches: _binned(batches, shared.value), "model_name string, bin int, low double, high double, pos double, neg double"))


def merged_bins(bins: DataFrame) -> DataFrame:
    return bins.groupBy(MODEL, "bin").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("pos").alias("pos"),
                                          F.sum("neg").alias("neg"))


def curve_points(bins: DataFrame) -> DataFrame:
    """The ends of all bins from the highest score on, with both rates, precision, areas and how far these may be off.

    (model_name, threshold, fpr, tpr, precision, roc_auc, roc_error, aupr, aupr_error); the start has no threshold.
    The window holds one model's bins, whose number is bounded.
    """
    by_model = Window.partitionBy(MODEL)
    upto = by_model.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    total = bins.select("*", *[F.sum(c).over(upto).alias(f"cum_{c}") for c in ("pos", "neg")],
                        *[F.sum(c).over(by_model).alias(f"all_{c}") for c in ("pos", "neg")])
    pos0, neg0 = F.col("cum_pos") - F.col("pos"), F.col("cum_neg") - F.col("neg")
    several = (F.col("low") < F.col("high")).cast("double")
    tpr, fpr = ratio("cum_pos", "all_pos"), ratio("cum_neg", "all_neg")
    dy, dx = ratio("pos", "all_pos"), ratio("neg", "all_neg")
    precision = ratio("cum_pos", F.col("cum_pos") + F.col("cum_neg"))
    first = F.coalesce(ratio(pos0, pos0 + neg0), F.lit(1.0))
    # The least and the greatest precision on any way through the bin.
    least = F.coalesce(ratio(pos0, pos0 + F.col("cum_neg")), F.lit(0.0))
    most = F.coalesce(ratio("cum_pos", F.col("cum_pos") + neg0), F.lit(1.0))
    points = total.select(
        MODEL, F.col("low").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"), precision.alias("precision"),
        (dx * (tpr - dy / 2)).alias("roc"), (dx * dy / 2 * several).alias("roc_off"),
        (dy * (precision + first) / 2).alias("pr"), (dy * (F.greatest(most, first) - F.least(least, precision)) * several).alias("pr_off"))
    start = bins.select(MODEL).distinct().select(
        MODEL, F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(c) for c, v in (
            ("fpr", 0.0), ("tpr", 0.0), ("precision", 1.0), ("roc", 0.0), ("roc_off", 0.0), ("pr", 0.0), ("pr_off", 0.0))])
    return points.unionByName(start).select(
        MODEL, "threshold", "fpr", "tpr", "precision",
        *[F.sum(c).over(by_model).alias(name) for c, name in (("roc", "roc_auc"), ("roc_off", "roc_error"), ("pr", "aupr"), ("pr_off", "aupr_error"))])


def bounded_curve(predictions: DataFrame, error: float = ERROR) -> DataFrame:
    """Curves whose areas are off by at most ``error``, with as many points as that takes; see ``curve_points``.

    A part of a class in every bin is enough for equal weights: the areas are then off by about half a part. Where weights are
    very unequal bins are made finer until the bound holds, each time with a pass for the quantiles and one for the bins. Of a
    pass the driver sees the largest bound. Beyond ``MOST_BINS`` parts the exact points (``evaluate.roc_points``) are the better choice,
    and this stops.
    """
    # Bins near the start of a precision-recall curve are off by more; all of them by about the logarithm of their number.
    bins = math.ceil(2 * max(1.0, math.log(2 / error)) / error)
    while True:
        found = cut_lineage(curve_bins(predictions, curve_bounds(predictions, bins)))
        points = curve_points(found)
        off = points.agg(F.max(F.greatest(F.coalesce("roc_error", F.lit(0.0)), F.coalesce("aupr_error", F.lit(0.0))))).head()[0]
        if off is None or off <= error:
            return points
        if bins > MOST_BINS:
            raise ValueError(f"areas are off by up to {off} with {bins} parts of each class; take the exact points")
        bins *= 4
