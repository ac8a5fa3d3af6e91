"""Weighted model evaluation, all models at once.

Input: ``predictions(model_name, id, y_true, y_pred, y_prob, weight)`` with 0/1
labels. A missing weight counts as 1, a NaN score as missing, and rows with another true
label are left out of everything. A model without a name is a model like the others. A
model may hold any share of the rows: every aggregate is by model with partial sums, and
curves go through range-wise totals.

All of it can be computed from ``collapse(predictions)`` as well: one row per model, labels and distinct score with the
sum of weights and the number of records, which can be added up again with others of its kind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.missing import ratio
from kinfold.operators.cumulative import running_totals
from kinfold.operators.merge import join_on
from kinfold.operators.ranking import shared_rank

MODEL = "model_name"

# Reported metrics in report order, those where less is better, and
# the distance kept from probabilities 0 and 1.
REPORTED = ["accuracy", "recall", "precision", "f1", "cross_entropy", "roc_auc", "cohen_kappa", "aupr"]
LESS_IS_BETTER = ["cross_entropy"]
PROBABILITY_MARGIN = 1e-15

_CELLS = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}


def clip_probability(p) -> Column:
    return F.greatest(F.least(p, F.lit(1 - PROBABILITY_MARGIN)), F.lit(PROBABILITY_MARGIN))


def _weight() -> Column:
    return F.coalesce(F.col("weight").cast("double"), F.lit(1.0))


def usable(predictions: DataFrame) -> DataFrame:
    """Predictions with a true label of 0 or 1, NaN scores made missing."""
    score = F.col("y_prob")
    return predictions.filter(F.col("y_true").isin(0, 1)).withColumn(
        "y_prob", F.when(~F.isnan(score.cast("double")), score))


RECORDS = "n_records"
STATE = [MODEL, "y_true", "y_pred", "y_prob"]


def _records(predictions: DataFrame) -> Column:
    """Records that a row stands for."""
    return F.col(RECORDS) if RECORDS in predictions.columns else F.lit(1)


def collapse(predictions: DataFrame) -> DataFrame:
    """A mergeable state of any predictions: weight and records by model, labels and distinct score.

    States of parts of the records, or of several models, are united and collapsed again; every metric and curve is the same
    from a state as from the records.
    """
    rows = usable(predictions)
    return rows.groupBy(*STATE).agg(F.sum(_weight()).alias("weight"), F.sum(_records(predictions)).cast("bigint").alias(RECORDS))


def _cell(name: str) -> Column:
    truth, guess = _CELLS[name]
    return (F.col("y_true") == truth) & (F.col("y_pred") == guess)


def _cell_sums() -> list[Column]:
    return [F.sum(F.when(_cell(c), _weight()).otherwise(F.lit(0.0))).alias(c) for c in _CELLS]


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """Four rows per model, positive label first: weight and its share of the true label."""
    sums = usable(predictions).groupBy(MODEL).agg(*_cell_sums())
    cells = F.array(*[
        F.struct(F.lit(truth).alias("true_label"), F.lit(guess).alias("predicted_label"), F.col(c).alias("weight"),
                 ratio(F.col(c), F.col("tp") + F.col("fn") if truth else F.col("fp") + F.col("tn")).alias("share"))
        for c, (truth, guess) in sorted(_CELLS.items(), key=lambda item: item[1], reverse=True)
    ])
    return sums.select(MODEL, F.inline(cells))


def class_metrics(predictions: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1, kappa and cross entropy, one row per model, from one pass."""
    p = clip_probability(F.col("y_prob"))
    loss = -F.ln(F.when(F.col("y_true") == 1, p).otherwise(1 - p))
    scored = F.col("y_prob").isNotNull()
    counts = [F.sum(F.when(_cell(c), _records(predictions)).otherwise(F.lit(0))).cast("double").alias(f"n_{c}") for c in _CELLS]
    sums = usable(predictions).groupBy(MODEL).agg(
        *_cell_sums(), *counts,
        F.sum(F.when(scored, loss * _weight())).alias("loss"),
        F.sum(F.when(scored, _weight())).alias("loss_weight"),
    )
    tp, fp, fn, tn = (F.col(c) for c in _CELLS)
    a, b, c, d = (F.col(f"n_{x}") for x in _CELLS)
    n = a + b + c + d
    observed = ratio(a + d, n)
    expected = ratio((a + b) * (a + c) + (c + d) * (b + d), n * n)
    zero = F.lit(0.0)
    return sums.select(
        MODEL,
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        F.coalesce(ratio(tp, tp + fp), zero).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), zero).alias("recall"),
        F.coalesce(ratio(tp * 2, tp * 2 + fp + fn), zero).alias("f1"),
        # Kappa counts records even where the other metrics weigh them.
        ratio(observed - expected, 1 - expected).alias("cohen_kappa"),
        ratio("loss", "loss_weight").alias("cross_entropy"),
    )


def _score_totals(predictions: DataFrame) -> DataFrame:
    """Per model and distinct score, from the highest score on: own and cumulated weight of both classes."""
    by_score = (
        usable(predictions).filter(F.col("y_prob").isNotNull())
        .groupBy(MODEL, F.col("y_prob").alias("score"))
        .agg(F.sum(F.when(F.col("y_true") == 1, _weight()).otherwise(F.lit(0.0))).alias("pos"),
             F.sum(F.when(F.col("y_true") == 0, _weight()).otherwise(F.lit(0.0))).alias("neg"))
    )
    return running_totals(by_score, [MODEL], "score", ["pos", "neg"], descending=True)


def _rates() -> dict[str, Column]:
    pos, neg, cum_pos, cum_neg = (F.col(c) for c in ("pos", "neg", "cum_pos", "cum_neg"))
    before_pos, before_neg = cum_pos - pos, cum_neg - neg
    return {
        "tpr": ratio(cum_pos, "all_pos"), "tpr_before": ratio(before_pos, "all_pos"),
        "fpr": ratio(cum_neg, "all_neg"), "fpr_before": ratio(before_neg, "all_neg"),
        "precision": ratio(cum_pos, cum_pos + cum_neg),
        # Before the first score nothing is predicted; precision is 1 there by convention.
        "precision_before": F.coalesce(ratio(before_pos, before_pos + before_neg), F.lit(1.0)),
    }


def roc_points(predictions: DataFrame) -> DataFrame:
    """(model_name, threshold, fpr, tpr): every distinct score, and the origin without a threshold."""
    rates = _rates()
    points = _score_totals(predictions).select(MODEL, F.col("score").alias("threshold"),
                                               rates["fpr"].alias("fpr"), rates["tpr"].alias("tpr"))
    return points.unionByName(_start(predictions, fpr=0.0, tpr=0.0))


def pr_points(predictions: DataFrame) -> DataFrame:
    """(model_name, threshold, recall, precision): every distinct score, and the end point (0, 1)."""
    rates = _rates()
    points = _score_totals(predictions).select(MODEL, F.col("score").alias("threshold"),
                                               rates["tpr"].alias("recall"), rates["precision"].alias("precision"))
    return points.unionByName(_start(predictions, recall=0.0, precision=1.0))


def _start(predictions: DataFrame, **values: float) -> DataFrame:
    models = usable(predictions).filter(F.col("y_prob").isNotNull()).select(MODEL).distinct()
    return models.select(MODEL, F.lit(None).cast("double").alias("threshold"),
                         *[F.lit(v).alias(name) for name, v in values.items()])


def curve_areas(predictions: DataFrame) -> DataFrame:
    """Areas under the ROC and precision-recall curves by trapezoids, one row per model."""
    r = _rates()
    roc = (r["fpr"] - r["fpr_before"]) * (r["tpr"] + r["tpr_before"]) / F.lit(2.0)
    pr = (r["tpr"] - r["tpr_before"]) * (r["precision"] + r["precision_before"]) / F.lit(2.0)
    areas = _score_totals(predictions).groupBy(MODEL).agg(F.sum(roc).alias("roc_auc"), F.sum(pr).alias("aupr"))
    return areas.select(MODEL, "roc_auc", F.col("roc_auc").alias("auc"), "aupr")


def all_metrics(predictions: DataFrame) -> DataFrame:
    """Every scalar metric, one row per model; probability metrics are missing without probabilities."""
    return join_on(class_metrics(predictions), curve_areas(predictions), [MODEL], "left", null_safe=True, split_hot=False)


def long_scores(metrics: DataFrame) -> DataFrame:
    """(model_name, metric, value) of the reported metrics."""
    return metrics.unpivot([MODEL], REPORTED, "metric", "value")


def ranked_scores(metrics: DataFrame) -> DataFrame:
    """Long scores with the rank of the model per metric and a best flag (none for a single model)."""
    scores = long_scores(metrics)
    signed = F.when(F.col("metric").isin(*LESS_IS_BETTER), -F.col("value")).otherwise(F.col("value"))
    scores = scores.withColumn("__signed", signed)
    rank = shared_rank(F.col("__signed"), ["metric"], descending=True)
    ranked = scores.withColumn("rank", rank)
    from pyspark.sql import Window

    by_metric = Window.partitionBy("metric")
    best = (F.col("__signed") == F.max("__signed").over(by_metric)) & (F.count("*").over(by_metric) > 1)
    return ranked.withColumn("is_best", F.coalesce(best, F.lit(False))).drop("__signed")


def score_table(metrics: DataFrame, models: Sequence[str]) -> DataFrame:
    """Metrics as rows, models as columns."""
    cells = [F.max(F.when(F.col(MODEL) == m, F.col("value"))).alias(m) for m in models]
    return long_scores(metrics).groupBy("metric").agg(*cells)


def model_comparison(metrics: DataFrame) -> DataFrame:
    """Models as rows with metrics, mean rank over metrics and best flags, best model first."""
    ranked = ranked_scores(metrics)
    table = ranked.groupBy(MODEL).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in REPORTED],
        *[F.max(F.when(F.col("metric") == m, F.col("is_best"))).alias(f"best_{m}") for m in REPORTED],
        F.avg("rank").alias("mean_rank"),
    )
    return table.orderBy("mean_rank", MODEL)


def precision_recall_table(comparison: DataFrame) -> DataFrame:
    """Recall and precision of every model, worst mean rank first."""
    return comparison.orderBy(F.desc("mean_rank"), MODEL).select(MODEL, "recall", "precision")


def histogram(df: DataFrame, column: str, target: str, compat_edges: bool = False) -> DataFrame:
    """(target, bin, n): counts in bins of width 1 by target value.

    ``compat_edges`` uses the edges -1, 0, … below ``max - 1``, outside of which the
    highest values fall; the last bin then also holds its upper edge.
    """
    value = F.col(column).cast("double")
    known = df.filter(value.isNotNull())
    if not compat_edges:
        return known.groupBy(target, F.floor(value).alias("bin")).agg(F.count("*").alias("n"))
    top = known.agg(F.ceil(F.max(value)).alias("top")).scalar()
    last_edge = top - 2
    bin_ = F.when(value == last_edge, last_edge - 1).otherwise(F.floor(value))
    inside = value.between(F.lit(-1.0), last_edge.cast("double"))
    return known.filter(inside).groupBy(target, bin_.alias("bin")).agg(F.count("*").alias("n"))


def split_features(df: DataFrame, weights: Sequence[str] = ("panelweight_2016",),
                   labels: Sequence[str] = ("dropout",)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Features, labels and weights as three frames."""
    return df.drop(*weights, *labels), df.select(*labels), df.select(*weights)
