"""Weighted linear model, full and restricted, with a sandwich covariance and per-row lift.

The model is fitted by a QR decomposition of the rows in a tree of small factors, which
keeps the digits that normal equations lose by squaring the design. Those come from one
aggregate over the rows: up to WIDE features as sums of products in generated code, beyond
that as partial Gram matrices of Arrow batches, summed by position; they give the sandwich's
middle and are the other solver. The driver only solves k x k systems.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.config import LIFT_FIELDS, check_choice
from cairn.functions.columns import dot

WIDE = 8  # features up to which sums of products are spelled out; more would take longer to compile than to sum
NARROW_LIFT = 8  # features up to which the standard error is a native expression


def gram_columns(xs: list[Column], w: Column, y: Column) -> dict[str, Column]:
    """Sums w xi xj (i <= j) as g_i_j and w xi y as m_i."""
    out = {f"g_{i}_{j}": F.sum(w * xs[i] * xs[j]) for i in range(len(xs)) for j in range(i, len(xs))}
    return out | {f"m_{i}": F.sum(w * x * y) for i, x in enumerate(xs)}


def _batched(rows: DataFrame, k: int) -> np.ndarray:
    """Sum over rows of w v v' for rows (v array, w), k long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            v = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            total += v.T @ (v * b.column(1).to_numpy(zero_copy_only=False)[:, None])
        yield pa.RecordBatch.from_pydict({"v": pa.array([total.ravel()], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(k * k)
    for r in parts:
        out[r.i] = r.x
    return out.reshape(k, k)


def normal_equations(df: DataFrame, x: Column, w: Column, y: Column, k: int) -> tuple[np.ndarray, np.ndarray]:
    """X'WX and X'Wy of array column x with k elements; a row in which x, an element of it,
    w or y is null, or x is of another length, counts for nothing, whichever path sums."""
    rows = df.select(x.cast("array<double>").alias("x"), w.cast("double").alias("w"), y.cast("double").alias("y"))
    rows = rows.filter("x is not null and w is not null and y is not null").filter((F.size("x") == k) & F.forall("x", lambda v: v.isNotNull()))
    if k <= WIDE:
        row = rows.agg(*[c.alias(n) for n, c in gram_columns([F.get("x", F.lit(i)) for i in range(k)], F.col("w"), F.col("y")).items()]).first()
        g = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                g[i, j] = g[j, i] = row[f"g_{i}_{j}"] or 0.0
        return g, np.array([row[f"m_{i}"] or 0.0 for i in range(k)])
    g = _batched(rows.select(F.concat("x", F.array("y")).alias("v"), "w"), k + 1)
    return g[:k, :k], g[:k, k]


def meat(df: DataFrame, x: Column, w: Column, y: Column, b: np.ndarray) -> np.ndarray:
    """Sum of w^2 e^2 x x' for the residuals of b; rows count as in normal_equations."""
    e = y - dot(x, b.tolist())
    return normal_equations(df, x, w * w * e * e, F.lit(0.0), len(b))[0]


GROUPS = 256  # of partitions, whose R factors the driver combines
QR_ROWS = 4096  # factored together


def qr_factor(df: DataFrame, x: Column, w: Column, y: Column, k: int) -> np.ndarray:
    """R of the QR decomposition of the rows sqrt(w) (x, y), (k + 1) by (k + 1), by a tree: each
    partition keeps the R of its rows so far, those are combined in GROUPS groups, and the rest by
    the driver. So the design is never squared. Rows count as in normal_equations; those of
    negative weight raise."""
    rows = df.select(x.cast("array<double>").alias("x"), w.cast("double").alias("w"), y.cast("double").alias("y"))
    rows = rows.filter("x is not null and w is not null and y is not null").filter((F.size("x") == k) & F.forall("x", lambda v: v.isNotNull()))
    rows = rows.select(F.concat("x", F.array("y")).alias("v"), F.when(F.col("w") < 0, F.raise_error(F.lit("negative weight"))).otherwise(F.sqrt("w")).alias("w"))
    size = k + 1

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, waiting, held = np.zeros((0, size)), [], 0
        for b in batches:
            v = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            waiting.append(v * b.column(1).to_numpy(zero_copy_only=False)[:, None])
            held += len(v)
            if held >= QR_ROWS:
                r, waiting, held = np.linalg.qr(np.concatenate([r, *waiting]), "r"), [], 0
        r = np.linalg.qr(np.concatenate([r, *waiting, np.zeros((size, size))]), "r")
        yield pa.RecordBatch.from_pydict({"v": pa.array(r.tolist(), pa.list_(pa.float64())), "w": np.ones(len(r))})

    def combine(table: pa.Table) -> pa.Table:
        r = np.zeros((size, size))
        for b in table.to_batches():
            r = np.linalg.qr(np.concatenate([r, b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)]), "r")
        return pa.table({"v": pa.array(r.tolist(), pa.list_(pa.float64()))})

    parts = rows.mapInArrow(factor, "v array<double>, w double").withColumn("part", F.spark_partition_id() % GROUPS)
    found = parts.groupBy("part").applyInArrow(combine, "v array<double>").collect()
    return np.linalg.qr(np.array([r.v for r in found] + [[0.0] * size] * size), "r")


def solve_qr(r: np.ndarray, restricted: int) -> dict[str, np.ndarray]:
    """As solve, from the R of the rows, and A = (X'WX)^-1. The restricted fit is that of the leading
    columns, whose R is the leading block. Columns that others determine (to RANK_TOL) get the minimum-norm fit."""
    k = len(r) - 1
    rx, ry = r[:k, :k], r[:k, k]
    scale = np.sqrt((rx**2).sum(0))
    scale[scale == 0] = 1.0

    def fitted(n: int) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients of the first n columns, and the inverse (or pseudo-inverse) of their R."""
        if not n:
            return np.zeros(0), np.zeros((0, 0))
        u, s, vt = np.linalg.svd(rx[:n, :n] / scale[:n])
        if s[-1] > RANK_TOL * s[0]:  # the columns' scales aside, which least squares does not see
            inv = (vt.T / s) @ u.T / scale[:n, None]
        else:
            inv = np.linalg.pinv(rx[:n, :n], rcond=RANK_TOL)
        return inv @ ry[:n], inv

    b, inv = fitted(k)
    a = inv @ inv.T
    e = np.eye(k)[k - restricted:]
    v = np.eye(k) - a @ e.T @ inverse(e @ a @ e.T) @ e if restricted else np.eye(k)
    b0 = np.concatenate([fitted(k - restricted)[0], np.zeros(restricted)])
    return {"b": b, "b0": b0, "V": v, "A": a}


RANK_TOL = 1e-12  # least singular value over the greatest, of columns of length 1


def inverse(m: np.ndarray) -> np.ndarray:
    """The inverse, or for collinear features the pseudo-inverse."""
    return np.linalg.inv(m) if np.linalg.matrix_rank(m) == len(m) else np.linalg.pinv(m)


def coefficients(gram: np.ndarray, moment: np.ndarray) -> np.ndarray:
    return np.linalg.solve(gram, moment) if np.linalg.matrix_rank(gram) == len(gram) else inverse(gram) @ moment


def solve(gram: np.ndarray, moment: np.ndarray, meat_sum: np.ndarray | None, restricted: int) -> dict[str, np.ndarray]:
    """Full and restricted coefficients (the last `restricted` ones 0), the restriction matrix, and, with the meat, the sandwich."""
    k = len(moment)
    a = inverse(gram)
    b = coefficients(gram, moment)
    r = np.eye(k)[k - restricted:]
    v = np.eye(k) - a @ r.T @ inverse(r @ a @ r.T) @ r if restricted else np.eye(k)
    b0 = v @ b
    b0[k - restricted:] = 0.0
    return {"b": b, "b0": b0, "V": v} | ({} if meat_sum is None else {"cov": a @ meat_sum @ a})


def _quad(u: list[Column], m: np.ndarray, v: list[Column]) -> Column:
    total = F.lit(0.0)
    for i, x in enumerate(u):
        for j, y in enumerate(v):
            if m[i, j]:
                total = total + x * y * float(m[i, j])
    return total


def clip01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def lift_struct(x: Column, x0: Column, model: dict[str, np.ndarray], corrected: bool = False) -> Column:
    """Struct of LIFT_FIELDS. A prediction of 0 gives null lifts and error. The error's last
    derivative is p_nm / p as published, or with corrected=True p_nm / p^2."""
    b, b0, cov, v = (np.asarray(model[n]) for n in ("b", "b0", "cov", "V"))
    k = len(b)
    pa_, pb, pan, pbn = dot(x, b0.tolist()), dot(x, b.tolist()), dot(x0, b0.tolist()), dot(x0, b.tolist())
    ratio = lambda p, q: F.try_divide(p, q)
    clipped = lambda c: F.when(c.isNull(), None).otherwise(clip01(c))
    lift_a, lift_b = clipped(1 - ratio(pan, pa_)), clipped(1 - ratio(pbn, pb))
    vc = v @ cov
    vcv = vc @ v.T
    if k <= NARROW_LIFT:
        j = [ratio(F.lit(1.0), pa_), -ratio(pan, pa_ * pa_), -ratio(F.lit(1.0), pb), ratio(pbn, pb * pb if corrected else pb)]
        xs, x0s = ([F.get(c, F.lit(i)) for i in range(k)] for c in (x, x0))
        u = [a0 * j[0] + a * j[1] for a, a0 in zip(xs, x0s, strict=True)]
        t = [a0 * j[2] + a * j[3] for a, a0 in zip(xs, x0s, strict=True)]
        var = _quad(u, vcv, u) + 2 * _quad(u, vc, t) + _quad(t, cov, t)
        se = F.sqrt(F.when(var < 0, 0.0).otherwise(var))
    else:

        def error(xa: pa.Array, x0a: pa.Array) -> pa.Array:
            mx, m0 = (c.flatten().to_numpy(zero_copy_only=False).reshape(-1, k) for c in (xa, x0a))
            with np.errstate(all="ignore"):
                qa, qb, qan, qbn = mx @ b0, mx @ b, m0 @ b0, m0 @ b
                u = m0 / qa[:, None] - mx * (qan / qa**2)[:, None]
                t = -m0 / qb[:, None] + mx * (qbn / (qb**2 if corrected else qb))[:, None]
                var = ((u @ vcv) * u).sum(1) + 2 * ((u @ vc) * t).sum(1) + ((t @ cov) * t).sum(1)
                out = np.sqrt(np.maximum(var, 0))
            return pa.array(out, mask=~np.isfinite(out))

        se = F.arrow_udf(error, "double")(x, x0)
    parts = [clipped(lift_b - lift_a), se, lift_a, lift_b, pa_, pb, pan, pbn]
    return F.struct(*[p.alias(n) for p, n in zip(parts, LIFT_FIELDS, strict=True)])


class _Columns(HasFeaturesCol, HasLabelCol, HasWeightCol, HasPredictionCol):
    nmFeaturesCol = Param(Params._dummy(), "nmFeaturesCol", "features without marketing", TypeConverters.toString)


class LiftRegression(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Weighted least squares, full and with the last `restricted` coefficients held at 0."""

    restricted = Param(Params._dummy(), "restricted", "coefficients held at 0, from the last", TypeConverters.toInt)
    solver = Param(Params._dummy(), "solver", "qr, or normal for the normal equations", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "conversionIndicator", weightCol: str = "purchase_weight", restricted: int = 2, solver: str = "qr") -> None:
        super().__init__()
        self._set(**self._input_kwargs | {k: v for k, v in {"featuresCol": featuresCol, "labelCol": labelCol, "weightCol": weightCol, "restricted": restricted, "solver": check_choice(solver, ("qr", "normal"), "solver")}.items()})

    def _fit(self, dataset: DataFrame) -> LiftRegressionModel:
        from .features import attribute_names

        names = attribute_names(dataset, self.getFeaturesCol())
        lean = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getWeightCol()).cast("double").alias("w"), F.col(self.getLabelCol()).cast("double").alias("y")).persist()
        try:  # two passes: the factor or the normal equations, then residuals
            x, w, y, restricted = F.col("x"), F.col("w"), F.col("y"), self.getOrDefault(self.restricted)
            if self.getOrDefault(self.solver) == "qr":
                found = solve_qr(qr_factor(lean, x, w, y, len(names)), restricted)
                a = found.pop("A")
                found["cov"] = a @ meat(lean, x, w, y, found["b"]) @ a
            else:
                gram, moment = normal_equations(lean, x, w, y, len(names))
                found = solve(gram, moment, meat(lean, x, w, y, coefficients(gram, moment)), restricted)
        finally:
            lean.unpersist()
        state = json.dumps({k: v.tolist() for k, v in found.items()} | {"names": names})
        return LiftRegressionModel(artifact=state, featuresCol=self.getFeaturesCol())


class LiftRegressionModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the lift struct; artifact holds b, b0, cov, V and the feature names as JSON."""

    artifact = Param(Params._dummy(), "artifact", "coefficients and matrices as JSON", TypeConverters.toString)
    corrected = Param(Params._dummy(), "corrected", "corrected last derivative of the error", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, artifact: str = "{}", featuresCol: str = "features", nmFeaturesCol: str = "nm_features", predictionCol: str = "prediction", corrected: bool = False) -> None:
        super().__init__()
        self._set(artifact=artifact, featuresCol=featuresCol, nmFeaturesCol=nmFeaturesCol, predictionCol=predictionCol, corrected=corrected)

    def state(self) -> dict:
        return json.loads(self.getOrDefault(self.artifact))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x, x0 = vector_to_array(F.col(self.getFeaturesCol())), vector_to_array(F.col(self.getOrDefault(self.nmFeaturesCol)))
        wide = dataset.withColumns({"_x": x, "_x0": x0})
        return wide.withColumn(self.getPredictionCol(), lift_struct(F.col("_x"), F.col("_x0"), self.state(), self.getOrDefault(self.corrected))).drop("_x", "_x0")

    def summary(self, spark) -> DataFrame:
        """(idx, name, restricted and full coefficients with robust standard errors)."""
        s = self.state()
        cov, v = np.array(s["cov"]), np.array(s["V"])
        se0, se = np.sqrt(np.maximum(np.diag(v @ cov @ v.T), 0)), np.sqrt(np.diag(cov))
        rows = [(i, n, float(a), float(b), float(c), float(d)) for i, (n, a, b, c, d) in enumerate(zip(s["names"], s["b0"], se0, s["b"], se, strict=True))]
        return spark.createDataFrame(rows, "idx int, name string, gnuA_coeff double, gnuA_robustse double, gnuB_coeff double, gnuB_robustse double")
