"""Scaled features and principal axes.

One aggregate gives means, deviations and all covariances at once, in one mergeable row
whatever the number of trips; the eigenvectors of that small matrix are taken on the driver.
Scores are column expressions, so projecting trips needs no Python and no second pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.operators.segments import FEATURES


@dataclass(frozen=True)
class Axes:
    """Means and deviations of the features, and axes by falling share of the variance. An
    axis's first loading that is not near zero is positive."""

    features: tuple[str, ...]
    means: np.ndarray
    deviations: np.ndarray
    shares: np.ndarray
    loadings: np.ndarray


def figures(rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """One row over the rows without a null feature: n, mean_i, std_i, and cov_i_j for i < j."""
    pairs = [(i, j) for i in range(len(features)) for j in range(i + 1, len(features))]
    return rows.dropna(subset=list(features)).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.avg(f).alias(f"mean_{i}") for i, f in enumerate(features)),
        *(F.stddev_samp(f).alias(f"std_{i}") for i, f in enumerate(features)),
        *(F.covar_samp(features[i], features[j]).alias(f"cov_{i}_{j}") for i, j in pairs),
    )


def principal_axes(rows: DataFrame, features: Sequence[str] = FEATURES) -> Axes:
    """Axes of the scaled features. A feature that never varies weighs nothing."""
    row = figures(rows, features).first()
    n = len(features)
    means = np.array([row[f"mean_{i}"] or 0.0 for i in range(n)])
    deviations = np.array([row[f"std_{i}"] or 0.0 for i in range(n)])
    scale = np.where(deviations > 0, deviations, 1.0)
    matrix = np.diag((deviations > 0).astype(float))
    for i in range(n):
        for j in range(i + 1, n):
            matrix[i, j] = matrix[j, i] = (row[f"cov_{i}_{j}"] or 0.0) / (scale[i] * scale[j])
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")
    values, vectors = np.maximum(values[order], 0), vectors[:, order].T
    for v in vectors:
        v *= np.sign(v[np.argmax(np.abs(v) > 1e-9)])
    return Axes(tuple(features), means, deviations, values / max(values.sum(), 1e-300), vectors)


def scaled(rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """``rows`` with scaled_<feature>, its distance from the mean in deviations; null where
    the feature is null or never varies. Mean and deviation are those of each feature's own
    values; they enter as a scalar subquery, so the trips are joined with nothing."""
    parts = [F.avg(f).alias(f"m{i}") for i, f in enumerate(features)]
    parts += [F.stddev_samp(f).alias(f"s{i}") for i, f in enumerate(features)]
    base = rows.agg(*parts)
    known = base.select(F.struct(*base.columns)).scalar()
    return rows.withColumns(
        {
            f"scaled_{f}": F.try_divide(F.col(f) - known[f"m{i}"], known[f"s{i}"])
            for i, f in enumerate(features)
        }
    )


def projected(rows: DataFrame, axes: Axes, n: int = 2) -> DataFrame:
    """``rows`` with axis_1 ... axis_n; null where a feature is null."""
    columns = {}
    for a in range(n):
        terms = [
            (F.col(f) - float(m)) * (float(w) / float(s))
            for f, m, s, w in zip(axes.features, axes.means, axes.deviations, axes.loadings[a])
            if s > 0
        ]
        columns[f"axis_{a + 1}"] = sum(terms[1:], terms[0]) if terms else F.lit(None).cast("double")
    return rows.withColumns(columns)


def axis_table(rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """axis, share of the variance, and a loading for each feature: as many rows as features."""
    axes = principal_axes(rows, features)
    table = [
        (a + 1, float(axes.shares[a]), *(float(w) for w in axes.loadings[a])) for a in range(len(features))
    ]
    schema = "axis int, share double, " + ", ".join(f"{f} double" for f in features)
    return rows.sparkSession.createDataFrame(table, schema)
