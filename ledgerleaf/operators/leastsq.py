"""Least squares on many series at once.

Spark aggregates, per series, the sums of products of all lagged columns: every
batch of rows becomes one matrix product per series, and these partial sums are
added up. What remains per series is a matrix whose size depends on the number of
lags only; small numpy solves finish on it.

Every column is measured from its first value in the series before products are
taken, so the level of a series costs no digits; coefficients are put back into
the columns' own terms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ledgerleaf.operators.series import in_time


def lag_moments(df: DataFrame, keys: Sequence[str], columns: Sequence[str], lags: int, padded: bool = False) -> DataFrame:
    """``keys, n, moments, about``: product sums of ``[1, column lags 0 … lags]`` per series.

    Rows are grouped by how many lags they have (``bucket`` = min(t − 1, lags)), so
    that the sample of any lag order is a sum over buckets. ``moments`` lists the
    upper triangle bucket by bucket, ``n`` the rows per bucket, ``about`` the values
    from which the columns are measured. With ``padded`` the columns stay as they
    are, what precedes a series is zero, and all rows are one sample.
    """
    w = in_time(keys)
    size = 1 + len(columns) * (lags + 1)
    base = {c: F.lit(0.0) if padded else F.coalesce(F.first(c).over(w).cast("double"), F.lit(0.0)) for c in columns}
    numbered = df.withColumns({"_t": F.row_number().over(w), **{f"_about_{i}": base[c] for i, c in enumerate(columns)}})
    cells = [F.lit(1.0)]
    for i, c in enumerate(columns):
        for k in range(lags + 1):
            value = F.col(c) if k == 0 else F.lag(c, k).over(w)
            cells.append(F.coalesce(value.cast("double") - F.col(f"_about_{i}"), F.lit(0.0)))
    bucket = F.lit(lags) if padded else F.least(F.col("_t") - 1, F.lit(lags))
    about = F.array(*[F.col(f"_about_{i}") for i in range(len(columns))])
    rows = numbered.select(*keys, bucket.cast("int").alias("_bucket"), about.alias("_about"), F.array(*cells).alias("_z"))
    upper = np.triu_indices(size)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple, list[int]] = {}
            for i, row in enumerate(zip(*[c.to_pylist() for c in batch.columns[: len(keys) + 1]])):
                groups.setdefault(row, []).append(i)
            if not groups:
                continue
            z = batch.column(len(keys) + 2).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            sums = [(z[at].T @ z[at])[upper] for at in groups.values()]
            first = pa.array([at[0] for at in groups.values()])
            yield pa.RecordBatch.from_arrays([
                *[c.take(first) for c in batch.columns[: len(keys) + 2]],
                pa.array([len(at) for at in groups.values()], pa.int64()), pa.array(sums, pa.list_(pa.float64())),
            ], [*keys, "_bucket", "_about", "_n", "_cells"])

    schema = rows.drop("_z").schema.add("_n", "long").add("_cells", ArrayType(DoubleType()))
    partial = rows.mapInArrow(products, schema)
    width = size * (size + 1) // 2
    zeros = F.array_repeat(F.lit(0.0), width)
    # As many partial sums as the series has batches of rows.
    total = F.aggregate(F.collect_list("_cells"), zeros, lambda a, x: F.zip_with(a, x, lambda u, v: u + v))
    sums = partial.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("n"), F.first("_about").alias("about"), total.alias("v"))
    placed = F.transform("v", lambda v, i: F.struct((F.col("_bucket") * width + i).alias("i"), v.alias("v")))
    # At most (lags + 1) · width entries per series, whatever its length.
    return sums.groupBy(*keys).agg(
        F.collect_list(F.struct(F.col("_bucket").alias("bucket"), "n")).alias("n"),
        F.flatten(F.collect_list(placed)).alias("moments"), F.first("about").alias("about"),
    )


class Moments:
    """Moment matrices of one series and the regressions they answer."""

    def __init__(self, columns: Sequence[str], lags: int, counts, cells, about=None):
        self.columns, self.lags = list(columns), lags
        size = 1 + len(columns) * (lags + 1)
        # What each place of the matrix is measured from; the constant is itself.
        self.about = np.concatenate([[0.0], np.repeat(np.zeros(len(columns)) if about is None else about, lags + 1)])
        width = size * (size + 1) // 2
        flat = np.zeros((lags + 1) * width)
        for cell in cells:
            flat[cell["i"]] = cell["v"]
        self.rows = np.zeros(lags + 1, dtype=int)
        for c in counts:
            self.rows[c["bucket"]] = c["n"]
        upper = np.triu_indices(size)
        self.matrices = np.zeros((lags + 1, size, size))
        for b in range(lags + 1):
            m = self.matrices[b]
            m[upper] = flat[b * width : (b + 1) * width]
            m.T[upper] = m[upper]

    def at(self, column: str, lag: int) -> int:
        return 1 + self.columns.index(column) * (self.lags + 1) + lag

    def sample(self, lags: int) -> tuple[int, np.ndarray]:
        """Row count and moment matrix of the rows that have at least ``lags`` lags."""
        return int(self.rows[lags:].sum()), self.matrices[lags:].sum(axis=0)

    def fit(self, targets: Sequence[int], regressors: Sequence[int], lags: int):
        """Coefficients, residual moments, inverse normal matrix and rows of a regression."""
        n, m = self.sample(lags)
        regressors, targets = list(regressors), list(targets)
        if 0 not in regressors or not n:
            # Without a constant the columns' own values count, so products about zero are put together again.
            back = np.eye(len(m)) + np.outer(self.about, np.eye(len(m))[0])
            m = back @ m @ back.T
            xx, xy = m[np.ix_(regressors, regressors)], m[np.ix_(regressors, targets)]
            inverse = scaled_inverse(xx)
            beta = inverse @ xy
            return beta, m[np.ix_(targets, targets)] - xy.T @ beta, inverse, n
        # With a constant among the regressors, it is swept out first: moments about the means.
        mean = m[0] / m[0, 0]
        about = m - np.outer(m[0], mean)
        at = [i for i, r in enumerate(regressors) if r != 0]
        rest, constant = [regressors[i] for i in at], regressors.index(0)
        xx, xy = about[np.ix_(rest, rest)], about[np.ix_(rest, targets)]
        slopes = scaled_inverse(xx)
        mean = mean + self.about
        inverse, beta = np.zeros((len(regressors),) * 2), np.zeros((len(regressors), len(targets)))
        inverse[np.ix_(at, at)] = slopes
        inverse[constant, at] = inverse[at, constant] = -slopes @ mean[rest]
        inverse[constant, constant] = 1 / m[0, 0] + mean[rest] @ slopes @ mean[rest]
        beta[at] = slopes @ xy
        beta[constant] = mean[targets] - mean[rest] @ beta[at]
        return beta, about[np.ix_(targets, targets)] - xy.T @ beta[at], inverse, n


def scaled_inverse(moments: np.ndarray) -> np.ndarray:
    """Pseudo-inverse of a moment matrix, found on the scale of correlations so that units do not matter."""
    scale = np.sqrt(np.maximum(np.diag(moments), 0))
    scale[scale == 0] = 1
    unit = np.outer(scale, scale)
    return np.linalg.pinv(moments / unit, rcond=1e-12, hermitian=True) / unit


def solved(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], lags: int, schema: str,
    solve: Callable[[Moments, pd.Series], list[tuple]],
) -> DataFrame:
    """Apply ``solve`` to every series' moments; its tuples follow the keys in ``schema``."""
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                moments = Moments(columns, lags, row["n"], row["moments"], row["about"])
                head = tuple(row[k] for k in keys)
                out += [head + tuple(r) for r in solve(moments, row)]
            yield pd.DataFrame(out, columns=names)

    return df.mapInPandas(run, schema)


def log_likelihood_aic(ssr: float, n: int, parameters: int) -> float:
    """Akaike's criterion of a Gaussian regression."""
    return n * (np.log(2 * np.pi) + np.log(max(ssr, 1e-300) / n) + 1) + 2 * parameters
