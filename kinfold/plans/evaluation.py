"""Evaluate one scored model, compare it with stored ones, and store it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators import evaluate
from kinfold.session import cut_lineage
from kinfold.sources.predictions import load_states, model_name, store_predictions

RECORD = ["model_name", "id", "y_true", "y_pred", "y_prob", "weight"]


@dataclass
class Evaluation:
    """Lazy frames over the written states of the models; the records themselves have been read once."""

    name: str
    metrics: DataFrame
    comparison: DataFrame
    confusion: DataFrame
    roc: DataFrame
    pr: DataFrame


def evaluate_model(scored: DataFrame, *, name: str | None = None, prefix: str | None = None,
                   compare_with: Sequence[str] = (), path: str | None = None, store: bool = False,
                   features: Sequence[str] | None = None) -> Evaluation:
    """Metrics of ``scored(id, y_true, y_pred[, y_prob, weight])``, next to stored models.

    ``compare_with`` names models under ``path``; with ``store`` this one joins them. The model's records are collapsed once,
    into a written state; the others come with theirs, so their records are not read again.
    """
    stored_name = model_name(name, prefix)
    for optional in ("y_prob", "weight"):
        if optional not in scored.columns:
            scored = scored.withColumn(optional, F.lit(None).cast("double"))
    own = scored.withColumn("model_name", F.lit(stored_name)).select(*RECORD)
    spark = own.sparkSession
    if store:
        store_predictions(own, path, features)
        state = load_states(spark, path, [stored_name])
    else:
        state = cut_lineage(evaluate.collapse(own))
    others = [m for m in compare_with if m != stored_name]
    if others:
        state = state.unionByName(load_states(spark, path, others))
    metrics = evaluate.all_metrics(state)
    return Evaluation(stored_name, metrics, evaluate.model_comparison(metrics),
                      evaluate.confusion_matrix(state), evaluate.roc_points(state), evaluate.pr_points(state))
