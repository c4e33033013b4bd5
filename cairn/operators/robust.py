"""Doubly robust effects: outcome models per arm, AIPW scores, lift, bootstrap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.config import CONTROL, OUTCOME_FOREST
from cairn.functions.columns import has_column, probability_of_one
from cairn.sources.readers import load_stage
from cairn.sources.sinks import generate_path

from .features import treatments_of
from .propensity import Propensity, column_of, fit_calibrators, fit_propensity, overlap, truncate
from .sampling import cap_sample, numbered, random_split

ROW = "_row_id"  # of a training row, by which it is drawn in the bootstrap


#: Cumulative Poisson(1) probabilities against 16-bit uniforms.
POISSON_STEPS = np.floor(np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 9)])) * 65536).astype(np.uint16)


def arm_rows(df: DataFrame, index: int) -> DataFrame:
    return df.filter(F.col("treatment_type_indexed") == float(index))


def treatment_index(labels: list[str], name: str) -> int:
    if name not in labels:
        raise ValueError(f"unknown treatment {name!r}")
    return labels.index(name)


def outcome_classifier(label: str = "conversionIndicator", seed: int = 12345) -> RandomForestClassifier:
    """Node ids are kept between levels: the trees are the same, but no row walks them anew at every level."""
    return RandomForestClassifier(featuresCol="features", labelCol=label, cacheNodeIds=True, seed=seed, **OUTCOME_FOREST)


def fit_outcome(train: DataFrame, labels: list[str], arm: str, estimator=None, seed: int = 12345):
    """An arm's outcome model, fitted on the arm's rows alone."""
    return (estimator or outcome_classifier(seed=seed)).fit(arm_rows(train, treatment_index(labels, arm)).withColumn("conversionIndicator", F.col("conversionIndicator").cast("double")))


def add_outcome(df: DataFrame, model, out: str) -> DataFrame:
    """P(conversion) under the arm's model, for all rows."""
    scored = model.transform(df)
    return scored.withColumn(out, probability_of_one(F.col(model.getProbabilityCol()))).drop(model.getProbabilityCol(), model.getRawPredictionCol(), model.getPredictionCol())


def propensity_of(df: DataFrame, treatment: str) -> Column:
    c = f"normalized_{column_of(treatment)}"
    return F.col(c if has_column(df, c) else column_of(treatment))


def aipw(df: DataFrame, treatment: str, label: str = "") -> DataFrame:
    """{t}_factual, {t}_counterfactual and {t}_dre. Without a label column the outcome is
    taken as 1. A propensity of exactly 0 or 1 gives null. Rows of other treatments count as untreated."""
    t, e = F.col(f"is_treated_by_{treatment}"), propensity_of(df, treatment)
    m1, m0 = F.col(f"{treatment}_probability"), F.col("probability_counterfactual")
    y = F.col(label).cast("double") if label and has_column(df, label) else F.lit(1.0)
    out = df.withColumns({f"{treatment}_factual": F.try_divide(t * (y - m1), e) + m1, f"{treatment}_counterfactual": F.try_divide((1 - t) * (y - m0), 1 - e) + m0})
    return out.withColumn(f"{treatment}_dre", F.col(f"{treatment}_factual") - F.col(f"{treatment}_counterfactual"))


def lift(df: DataFrame, treatment: str) -> DataFrame:
    """{t}_lift = max(0, 1 - counterfactual / factual); 0 if factual is 0."""
    f, cf = F.col(f"{treatment}_factual"), F.col(f"{treatment}_counterfactual")
    value = 1 - F.try_divide(cf, f)
    return df.withColumn(f"{treatment}_lift", F.when(f.isNull() | cf.isNull(), None).when(f == 0, 0.0).when(value > 0, value).otherwise(0.0))


def bootstrap(df: DataFrame, values: dict[str, tuple[str, str]], key: Column, replicates: int = 1000, seed: int = 12345) -> DataFrame:
    """(treatment, replicate, ate, att): Poisson(1) bootstrap means over all rows and over
    treated ones. values: of each treatment its value and its treated column; all are summed in
    one pass under the same draws. A row's weights come from a counter-based generator keyed by
    (seed, md5 of its key), so results do not depend on partitioning, and rows of equal key are
    drawn together: the key must tell rows apart. Null values count for nothing. Only sums for each
    replicate are shuffled."""
    names = list(values)
    cols = [F.col(c).cast("double").alias(f"{k}{i}") for i, t in enumerate(names) for k, c in zip("vt", values[t], strict=True)]
    rows = df.select(F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("long").alias("k"), *cols).filter("k is not null")
    steps = POISSON_STEPS
    kinds = ("sv", "n", "stv", "nt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4 * len(names), replicates))
        lanes = -(-replicates // 4)
        salt = (np.arange(lanes, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(seed)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                k = b.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
                h = k[:, None] * np.uint64(0xBF58476D1CE4E5B9) + salt[None]  # splitmix64: a bijection of (row, lane)
                h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                u = np.ascontiguousarray(h ^ (h >> np.uint64(31))).view(np.uint16)[:, :replicates]
                w = np.zeros(u.shape)
                for s in steps[:-1]:
                    w += u >= s
                left = []
                for i in range(len(names)):
                    v, t = (b.column(1 + 2 * i + j).to_numpy(zero_copy_only=False).astype(float) for j in (0, 1))
                    on = ~np.isnan(v)
                    v, t = np.where(on, v, 0.0), np.where(on, np.nan_to_num(t), 0.0)
                    left += [v, on.astype(float), t * v, t]
                sums += np.stack(left) @ w
        for i, t in enumerate(names):
            yield pa.RecordBatch.from_pydict({"treatment": [t] * replicates, "replicate": np.arange(replicates, dtype=np.int32), **{n: sums[4 * i + j] for j, n in enumerate(kinds)}})

    parts = rows.mapInArrow(run, "treatment string, replicate int, sv double, n double, stv double, nt double")
    sums = parts.groupBy("treatment", "replicate").agg(*[F.sum(c).alias(c) for c in kinds])
    return sums.select("treatment", "replicate", F.try_divide("sv", "n").alias("ate"), F.try_divide("stv", "nt").alias("att"))


def effects(df: DataFrame, treatments: list[str], key: Column, replicates: int = 1000, sample_size: int | None = None, seed: int = 12345) -> list[tuple]:
    """(treatment, estimand, estimate, ci_lo, ci_hi) of ATE and ATT, each with its own
    interval, all treatments in one pass over the rows. sample_size caps the rows, if given."""
    rows = cap_sample(df, sample_size, seed) if sample_size else df
    found = bootstrap(rows, {t: (f"{t}_dre", f"is_treated_by_{t}") for t in treatments}, key, replicates, seed)
    ci = lambda c: F.percentile(c, [0.025, 0.975])  # of as many values as replicates
    by = {r.treatment: r for r in found.groupBy("treatment").agg(*[f(c).alias(f"{c}_{n}") for c in ("ate", "att") for n, f in (("mean", F.avg), ("ci", ci))]).collect()}
    return [(t, c.upper(), by[t][f"{c}_mean"], *(by[t][f"{c}_ci"] or [None, None])) for t in treatments for c in ("ate", "att")]


def analytic_effects(df: DataFrame, treatments: list[str]) -> DataFrame:
    """(treatment, estimand, estimate, ci_lo, ci_hi) with mean +- 1.96 sd / sqrt(n), all treatments in one aggregate."""
    aggs = []
    for t in treatments:
        for name, c in (("ATE", F.col(f"{t}_dre")), ("ATT", F.when(F.col(f"is_treated_by_{t}") == 1, F.col(f"{t}_dre")))):
            aggs.append(F.struct(F.lit(t).alias("treatment"), F.lit(name).alias("estimand"), F.avg(c).alias("m"), (1.96 * F.stddev_samp(c) / F.sqrt(F.count(c))).alias("h")))
    return df.agg(F.array(*aggs).alias("x")).select(F.explode("x").alias("x")).select("x.treatment", "x.estimand", F.col("x.m").alias("estimate"), (F.col("x.m") - F.col("x.h")).alias("ci_lo"), (F.col("x.m") + F.col("x.h")).alias("ci_hi"))


class _HasRobust(Params):
    labels = Param(Params._dummy(), "labels", "treatment labels by index", TypeConverters.toListString)
    propensityModel = Param(Params._dummy(), "propensityModel", "kind of the propensity model", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "outcome", TypeConverters.toString)
    replicates = Param(Params._dummy(), "replicates", "bootstrap replicates", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    crossValidation = Param(Params._dummy(), "crossValidation", "search the propensity model's parameters", TypeConverters.toBoolean)


class DoublyRobustModel(Model, _HasRobust, MLWritable, MLReadable):
    """Everything scoring needs: labels, propensity with calibrators, outcome models,
    training effects. Saved and loaded whole, alone or as a stage of a pipeline."""

    def __init__(self, labels: list[str] | None = None, propensity: Propensity | None = None, outcomes: dict[str, object] | None = None, effects: list[tuple] | None = None, test: DataFrame | None = None) -> None:
        super().__init__()
        self.propensity, self.outcomes, self.effects, self.test = propensity, outcomes or {}, effects or [], test
        if labels is not None:
            self._set(labels=labels)

    def treatments(self) -> list[str]:
        return treatments_of(self.getOrDefault(self.labels))

    def score(self, df: DataFrame, label: str = "", calibrated: bool = True) -> DataFrame:
        """Per treatment: propensities, outcome probabilities, AIPW parts and lift."""
        out = self.propensity.transform(df, calibrated)
        out = add_outcome(out, self.outcomes[CONTROL], "probability_counterfactual")
        for t in self.treatments():
            out = lift(aipw(add_outcome(out, self.outcomes[t], f"{t}_probability"), t, label), t)
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.score(dataset)

    def write(self) -> MLWriter:
        return _RobustWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _RobustReader()


class _RobustWriter(MLWriter):
    def __init__(self, model: DoublyRobustModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        extra = {"kind": m.propensity.kind, "calibrated": sorted(m.propensity.calibrators or []), "arms": sorted(m.outcomes), "effects": m.effects, "metrics": m.propensity.metrics}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"robust": extra})
        parts = {"propensity": m.propensity.model} | {f"calibrator/{k}": v for k, v in (m.propensity.calibrators or {}).items()} | {f"outcome/{k}": v for k, v in m.outcomes.items()}
        for name, part in parts.items():
            part.write().overwrite().save(generate_path(path, name))


class _RobustReader(MLReader):
    def load(self, path: str) -> DoublyRobustModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        extra = meta["robust"]
        at = lambda *name: load_stage(self.sparkSession, generate_path(path, *name))
        out = DoublyRobustModel(outcomes={a: at("outcome", a) for a in extra["arms"]}, effects=[tuple(e) for e in extra["effects"]])
        DefaultParamsReader.getAndSetParams(out, meta)
        calibrators = {c: at("calibrator", c) for c in extra["calibrated"]}
        out.propensity = Propensity(at("propensity"), out.getOrDefault(out.labels), extra["kind"], calibrators or None, extra["metrics"])
        return out


class DoublyRobust(Estimator, _HasRobust, DefaultParamsReadable, DefaultParamsWritable):
    """split, propensity, calibration, truncation, overlap, outcome models, effects. Other
    estimators than the usual ones are given to the constructor and are not saved."""

    def __init__(self, labels: list[str] | None = None, propensity_model: str = "RandomForest", label: str = "conversionIndicator", replicates: int = 1000, seed: int = 12345, propensity_estimator: object = None, outcome_estimator: object = None, cross_validation: bool = False, grid: dict[str, list] | None = None) -> None:
        super().__init__()
        self._set(propensityModel=propensity_model, labelCol=label, replicates=replicates, seed=seed, crossValidation=cross_validation, **({} if labels is None else {"labels": labels}))
        self.propensity_estimator, self.outcome_estimator, self.grid = propensity_estimator, outcome_estimator, grid

    def _fit(self, dataset: DataFrame) -> DoublyRobustModel:
        labels, label = self.getOrDefault(self.labels), self.getOrDefault(self.labelCol)
        rows = dataset.select("features", "treatment_type", "treatment_type_indexed", label, *[f"is_treated_by_{x}" for x in labels])
        # many passes, and a row's id and side of the split must be the same in all of them
        with numbered(rows, ROW) as fixed:
            return self._fit_rows(fixed, labels, label)

    def _fit_rows(self, df: DataFrame, labels: list[str], label: str) -> DoublyRobustModel:
        seed, kind, arms = self.getOrDefault(self.seed), self.getOrDefault(self.propensityModel), treatments_of(labels)
        train, test = random_split(df, seed=seed)
        found = fit_propensity(train, labels, kind, seed=seed, estimator=self.propensity_estimator, test=test, cross_validation=self.getOrDefault(self.crossValidation), grid=self.grid)
        scored_train, scored_test = found.transform(train), found.transform(test)
        if kind == "RandomForest":
            found.calibrators = fit_calibrators(scored_train, labels)
            scored_train, scored_test = found.transform(train), found.transform(test)
        scored_train, scored_test = (truncate(x, labels) for x in (scored_train, scored_test))
        scored_train, scored_test = overlap(scored_train, scored_test, labels, "treatment_type_indexed")
        scored_train = scored_train.persist()
        try:
            outcomes = {arm: fit_outcome(scored_train, labels, arm, self.outcome_estimator, seed) for arm in (CONTROL, *arms)}
            every = add_outcome(scored_train.unionByName(scored_test), outcomes[CONTROL], "probability_counterfactual")
            for t in arms:
                every = aipw(add_outcome(every, outcomes[t], f"{t}_probability"), t, label)
            model = DoublyRobustModel(labels, found, outcomes, effects(every, arms, F.col(ROW), self.getOrDefault(self.replicates), seed=seed), scored_test)
            return self._copyValues(model)
        finally:
            scored_train.unpersist()
