"""Propensity of each treatment: multinomial model, calibration, truncation, overlap."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.config import FOREST, LOGISTIC, PLATT, PROPENSITY_MODELS, check_choice
from cairn.functions.columns import has_column, probability_of_one, within

from .metrics import multiclass_metrics
from .sampling import cap_classes, class_weights
from .tuning import best_params, cross_validate

log = logging.getLogger("cairn")


def column_of(label: str) -> str:
    return f"{label}_propensity_probability"


def classifier(kind: str, features: str = "features", label: str = "treatment_type_indexed", weight: str | None = "class_weight", seed: int = 12345):
    check_choice(kind, PROPENSITY_MODELS, "propensity model")
    common = {"featuresCol": features, "labelCol": label} | ({"weightCol": weight} if weight else {})
    if kind == "LogisticRegression":
        return LogisticRegression(**LOGISTIC, **common)
    return RandomForestClassifier(**FOREST, cacheNodeIds=True, seed=seed, **common)  # the same trees, without walking them anew at every level


def label_columns(scored: DataFrame, labels: list[str], vector: str = "probability") -> DataFrame:
    """One column per label from the probability vector, whose slots follow the indexer's labels."""
    p = vector_to_array(F.col(vector))
    return scored.withColumns({column_of(x): F.get(p, F.lit(i)) for i, x in enumerate(labels)})


@dataclass
class Propensity:
    """A fitted propensity model and the labels and calibrators that belong to it."""

    model: object
    labels: list[str]
    kind: str
    calibrators: dict[str, LogisticRegressionModel] | None = None
    metrics: dict[str, object] | None = None  # of the test rows: classes by name, weighted
    best_params: dict[str, object] | None = None  # of cross-validation

    def transform(self, df: DataFrame, calibrated: bool = True) -> DataFrame:
        """Raw columns, then normalized ones: calibrated if there are calibrators and it is
        asked for. A probability column that df has stays as original_probability."""
        if has_column(df, "probability"):
            df = df.withColumnRenamed("probability", "original_probability")
        out = self.model.transform(df.drop("prediction", "rawPrediction"))
        out = label_columns(out, self.labels).drop("prediction", "probability", "rawPrediction")
        return calibrate(out, self.labels, self.calibrators if calibrated else None)


def fit_propensity(train: DataFrame, labels: list[str], kind: str = "RandomForest", balance: bool = True, seed: int = 12345, estimator=None, test: DataFrame | None = None, cross_validation: bool = False, grid: dict[str, list] | None = None, folds: int = 5) -> Propensity:
    """Fits on class-capped, class-weighted rows; the rows passed on elsewhere stay all. With
    cross_validation, by the parameters of the grid that do best; with test rows, metrics are of those."""
    rows = cap_classes(train, "treatment_type_indexed", seed=seed) if balance else train
    rows = class_weights(rows, "treatment_type_indexed") if balance else rows.withColumn("class_weight", F.lit(1.0))
    rows = rows.select("features", "treatment_type_indexed", "class_weight").persist()
    best = None
    try:
        model = estimator or classifier(kind, seed=seed)
        if cross_validation:
            found = cross_validate(rows, model, "treatment_type_indexed", grid, folds, seed=seed)
            model, best = found.bestModel, best_params(found)
        else:
            model = model.fit(rows)
    finally:
        rows.unpersist()
    out = Propensity(model, labels, kind, best_params=best)
    if test is not None:
        by, weighted = multiclass_metrics(model.transform(test.select("features", "treatment_type_indexed")), "treatment_type_indexed", labels)
        out.metrics = {"classes": by, "weighted": weighted}
    return out


def fit_platt(train: DataFrame, score: str, label: str) -> LogisticRegressionModel:
    """One-feature logistic regression of a flag on a raw score (pure L1)."""
    x = VectorAssembler(inputCols=[score], outputCol="_platt").transform(train.select(score, label))
    return LogisticRegression(featuresCol="_platt", labelCol=label, **PLATT).fit(x)


def platt(df: DataFrame, score: str, model: LogisticRegressionModel) -> DataFrame:
    """calibrated_{score}: a sigmoid of the score, as one expression."""
    z = F.col(score) * float(model.coefficients[0]) + float(model.intercept)
    return df.withColumn(f"calibrated_{score}", 1 / (1 + F.exp(-z)))


def fit_calibrators(train: DataFrame, labels: list[str]) -> dict[str, LogisticRegressionModel]:
    """One for each label; the scores are made once for all of them."""
    scores = train.select(*[column_of(x) for x in labels], *[f"is_treated_by_{x}" for x in labels]).persist()
    try:
        return {x: fit_platt(scores, column_of(x), f"is_treated_by_{x}") for x in labels}
    finally:
        scores.unpersist()


def calibrate(df: DataFrame, labels: list[str], calibrators: dict[str, LogisticRegressionModel] | None) -> DataFrame:
    """normalized_* columns: calibrated scores over their sum, or the raw ones as they are."""
    if not calibrators:
        return df.withColumns({f"normalized_{column_of(x)}": F.col(column_of(x)) for x in labels})
    for x in labels:
        df = platt(df, column_of(x), calibrators[x])
    total = sum((F.col(f"calibrated_{column_of(x)}") for x in labels), F.lit(0.0))
    return df.withColumns({f"normalized_{column_of(x)}": F.try_divide(F.col(f"calibrated_{column_of(x)}"), total) for x in labels})


def filter_by_range(df: DataFrame, col: str, lower: float = 0.05, upper: float = 0.95) -> DataFrame:
    return df.filter(F.col(col).between(lower, upper))


def truncate(df: DataFrame, labels: list[str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Rows whose every raw propensity lies inside the bounds."""
    return df.filter(within([column_of(x) for x in labels], lower, upper))


def overlap_bounds(train: DataFrame, labels: list[str]) -> tuple[float, float] | None:
    """Largest of the labels' minima and smallest of their maxima; None if they do not
    overlap. One aggregate for all labels."""
    cols = [column_of(x) for x in labels]
    row = train.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)], *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    lows, highs = [row[f"lo{i}"] for i in range(len(cols))], [row[f"hi{i}"] for i in range(len(cols))]
    if any(v is None for v in lows + highs) or max(lows) > min(highs):
        return None
    return max(lows), min(highs)


def overlap(train: DataFrame, test: DataFrame, labels: list[str], arm: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of both inside the common support of the training rows. With the arm's column, bounds that leave some
    arm of the training rows without any row count as no overlap, and all rows stay: the
    propensities of a row sum to 1, so of three labels, say, no row has all above one third."""
    bounds = overlap_bounds(train, labels)
    if bounds is None:
        return train, test
    inside = within([column_of(x) for x in labels], *bounds)
    if arm is not None and train.groupBy(arm).agg(F.count_if(inside).alias("n")).agg(F.min("n")).first()[0] == 0:
        log.warning("the common support %s leaves an arm without rows; all rows stay", bounds)
        return train, test
    return train.filter(inside), test.filter(inside)



__all__ = ["Propensity", "calibrate", "classifier", "column_of", "filter_by_range", "fit_calibrators", "fit_platt", "fit_propensity", "label_columns", "overlap", "overlap_bounds", "platt", "probability_of_one", "truncate"]
