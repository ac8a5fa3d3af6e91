"""Stored predictions, one partition per model, each with a state that metrics can be computed from.

The state (``evaluate.collapse``) lies beside the predictions and carries their time of storing. It counts only as long as
the predictions of its model have the same time, so one that is left over from an earlier storing is never used.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kinfold.operators.evaluate import RECORDS, STATE, collapse


def model_name(name: str | None = None, prefix: str | None = None) -> str:
    """Stored name of a model: ``score`` if none is given, after an optional prefix."""
    return "_".join(part for part in (prefix, name or "score") if part is not None)


def _states(path: str) -> str:
    return f"{path.rstrip('/')}_states"


def store_predictions(predictions: DataFrame, path: str, features: Sequence[str] | None = None) -> None:
    """Store scored records with the feature names and the time of storing, and the state of each model.

    A model stored before under the same name is replaced, other models stay; doing
    it again after a lost job gives the same table. States are written last: until then the old ones don't count any more.
    """
    names = F.lit(None).cast("array<string>") if features is None else F.array(*[F.lit(f) for f in features])
    now = F.lit(dt.datetime.now(dt.timezone.utc))
    _replace_models(predictions.withColumns({"features": names, "stored_at": now}), path)
    _replace_models(collapse(_complete(predictions)).withColumn("stored_at", now), _states(path))


def _complete(predictions: DataFrame) -> DataFrame:
    return predictions.withColumns({c: F.lit(None).cast("double") for c in ("y_prob", "weight") if c not in predictions.columns})


def _replace_models(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model_name").parquet(path)


def _read_models(spark: SparkSession, path: str, models: Sequence[str] | None) -> DataFrame:
    # A name such as "01" must stay text although it comes from a folder name.
    found = spark.read.parquet(path).schema
    found = StructType([f if f.name != "model_name" else StructField("model_name", StringType()) for f in found])
    stored = spark.read.schema(found).parquet(path)
    return stored.filter(F.col("model_name").isin(*models)) if models is not None else stored


def load_predictions(spark: SparkSession, path: str, models: Sequence[str] | None = None) -> DataFrame:
    """Stored predictions; naming models reads only their partitions."""
    return _read_models(spark, path, models)


def load_states(spark: SparkSession, path: str, models: Sequence[str]) -> DataFrame:
    """The states of stored models, without reading their predictions.

    A model without a state of its last storing gets one from its predictions. Whether there is one takes the first
    row of each model's predictions and states.
    """
    fresh, stale = [], []
    for model in models:
        times = [_stored_at(spark, place, model) for place in (path, _states(path))]
        (fresh if times[0] is not None and times[0] == times[1] else stale).append(model)
    parts = []
    if fresh:
        parts.append(_read_models(spark, _states(path), fresh).drop("stored_at"))
    if stale or not parts:
        parts.append(collapse(_complete(load_predictions(spark, path, stale))))
    columns = [*STATE, "weight", RECORDS]
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def _stored_at(spark: SparkSession, path: str, model: str):
    try:
        first = _read_models(spark, path, [model]).select("stored_at").head(1)
    except AnalysisException:  # nothing was stored there yet
        return None
    return first[0].stored_at if first else None
