"""Asset index: first principal component of standardised columns."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """Weight, means and centred cross products of some rows.

    Means are kept as a row of the data and an offset from it, so that columns which vary little around a large value keep
    their digits. Two such states can be merged, in any order and as often as it takes.
    """

    weight: float
    origin: np.ndarray
    offset: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray, weights: np.ndarray) -> Moments:
        origin = rows[0]
        # Near the origin these differences are exact.
        centred = rows - origin
        weight = weights.sum()
        offset = weights @ centred / weight if weight else np.zeros(rows.shape[1])
        centred = centred - offset
        return cls(weight, origin, offset, centred.T @ (centred * weights[:, None]))

    def merged(self, other: Moments | None) -> Moments:
        if other is None or other.weight == 0:
            return self
        if self.weight == 0:
            return other
        weight = self.weight + other.weight
        apart = (other.origin - self.origin) + (other.offset - self.offset)
        share = other.weight / weight
        return Moments(weight, self.origin, self.offset + apart * share,
                       self.products + other.products + np.outer(apart, apart) * (self.weight * share))

    def batch(self) -> pa.RecordBatch:
        values = [self.origin, self.offset, self.products[np.triu_indices(len(self.origin))]]
        return pa.RecordBatch.from_arrays([pa.array([float(self.weight)]), *[pa.array([v], pa.list_(pa.float64())) for v in values]],
                                          ["weight", "origin", "offset", "products"])

    @classmethod
    def read(cls, row) -> Moments:
        origin, offset, upper = (np.array(row[c], float) for c in ("origin", "offset", "products"))
        products = np.zeros((len(origin), len(origin)))
        products[np.triu_indices(len(origin))] = upper
        return cls(row["weight"], origin, offset, products + np.triu(products, 1).T)


_MOMENTS = "weight double, origin array<double>, offset array<double>, products array<double>"


def _task_moments(batches):
    """One state for the rows of a task; the first column is the weight."""
    state = None
    for batch in batches:
        if batch.num_rows:
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            state = Moments.of(values[:, 1:], values[:, 0]).merged(state)
    if state is not None:
        yield state.batch()


def _merged_moments(batches):
    state = None
    for batch in batches:
        for row in batch.to_pylist():
            state = Moments.read(row).merged(state)
    if state is not None:
        yield state.batch()


def column_moments(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> Moments | None:
    """Weight, means and centred cross products of the complete rows, from one pass over them; None without any.

    Every task gives one state of columns^2 / 2 numbers. States are merged in tasks, about as many as the root of their
    number, before the rest comes to the driver.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    complete = df.select(w.alias("__w"), *[F.col(c).cast("double").alias(c) for c in columns]).na.drop()
    states = complete.mapInArrow(_task_moments, _MOMENTS)
    few = max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    merged = states.repartition(few).mapInArrow(_merged_moments, _MOMENTS)
    total = None
    for row in merged.collect():
        total = Moments.read(row).merged(total)
    return total


@dataclass
class Component:
    """First component of the correlation matrix: per column its mean (as origin + offset), deviation and loading."""

    origin: np.ndarray
    offset: np.ndarray
    deviations: np.ndarray
    loadings: np.ndarray


def principal_component(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> Component:
    """Means, standard deviations and loadings of the first component of the correlation matrix.

    Only complete rows count, each ``weight`` times. The sign is fixed so that the
    loading of largest magnitude is positive.
    """
    moments = column_moments(df, columns, weight)
    if moments is None or moments.weight == 0:
        return Component(*[np.zeros(len(columns))] * 4)
    n = moments.weight
    covariance = moments.products / n
    deviations = np.sqrt(np.clip(np.diag(covariance), 0, None))
    # A column without variation carries no information. Sums of centred values are exactly zero there.
    steps = np.divide(1.0, deviations, out=np.zeros_like(deviations), where=deviations > 0)
    loadings = np.linalg.eigh(covariance * np.outer(steps, steps))[1][:, -1]
    if loadings[np.abs(loadings).argmax()] < 0:
        loadings = -loadings
    # The usual estimate divides by n - 1.
    return Component(moments.origin, moments.offset, deviations * np.sqrt(n / max(n - 1, 1)), loadings)


def asset_index(df: DataFrame, columns: Sequence[str], name: str = "asset_index", weight: str | None = None) -> DataFrame:
    """Add the score of the first component, missing where any column is missing.

    Scoring is a plain column expression in the row's own stage.
    """
    found = principal_component(df, columns, weight)
    score = F.lit(0.0)
    for c, origin, offset, deviation, loading in zip(columns, found.origin, found.offset, found.deviations, found.loadings):
        step = float(loading / deviation) if deviation > 0 else 0.0
        score = score + (F.col(c).cast("double") - F.lit(float(origin)) - F.lit(float(offset))) * F.lit(step)
    return df.withColumn(name, score)
