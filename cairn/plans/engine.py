"""Entry points: train, score, summarize. IO is at the edges; between them are DataFrames."""

from __future__ import annotations

import json
import logging
import time
from dataclasses import asdict, dataclass, field
from functools import wraps

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from cairn.config import CONTROL, MODEL_TYPES, PROPENSITY_MODELS, LiftConfig, check_choice
from cairn.operators.features import attribute_names, feature_pipeline, fit_pipeline, indexer_labels, marketing_mask, no_marketing_mask, treatments_of
from cairn.operators.linear import LiftRegression, LiftRegressionModel
from cairn.operators.metrics import prediction_summary
from cairn.operators.report import regression_output, robust_output
from cairn.operators.robust import DoublyRobust, DoublyRobustModel
from cairn.sources import readers, sinks
from cairn.sources.readers import SchemaCatalog

log = logging.getLogger("cairn")


def timed(f):
    """Logs a step's wall-clock time."""

    @wraps(f)
    def run(*args, **kwargs):
        began = time.perf_counter()
        out = f(*args, **kwargs)
        log.info("%s: %.2f s", f.__name__, time.perf_counter() - began)
        return out

    return run


@dataclass
class Bundle:
    """What training leaves and scoring takes: the fitted feature pipeline and one of the models."""

    pipeline: PipelineModel
    labels: list[str]
    conf: LiftConfig
    model_type: str
    regression: LiftRegressionModel | None = None
    robust: DoublyRobustModel | None = None

    def save(self, path: str) -> None:
        """Everything under one folder; meta.json is written by Spark, so any file system will do."""
        at = sinks.generate_path
        sinks.write_pipeline(self.pipeline, path)
        meta = {"labels": self.labels, "conf": asdict(self.conf), "model_type": self.model_type}
        model = self.regression if self.robust is None else self.robust
        model.write().overwrite().save(at(path, "models", self.model_type))
        SparkSession.getActiveSession().createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(at(path, "meta"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> Bundle:
        at = sinks.generate_path
        meta = json.loads(spark.read.text(at(path, "meta")).first()[0])
        out = Bundle(readers.load_pipeline(at(path, "data_pipeline")), meta["labels"], LiftConfig(**meta["conf"]), meta["model_type"])
        if out.model_type == "regression":
            out.regression = LiftRegressionModel.load(at(path, "models", out.model_type))
        else:
            out.robust = DoublyRobustModel.load(at(path, "models", out.model_type))
        return out


@timed
def train(conversions: DataFrame, catalog: SchemaCatalog, conf: LiftConfig = LiftConfig(), model_type: str = "regression", propensity_model: str = "LogisticRegression", bucketize: bool = False, **options) -> Bundle:
    """Fits features and model on prepared conversions. options go to the doubly robust estimator."""
    check_choice(model_type, MODEL_TYPES, "model_type")
    check_choice(propensity_model, PROPENSITY_MODELS, "propensity_model")
    pipeline = fit_pipeline(feature_pipeline(catalog, conf, model_type, propensity_model, bucketize), conversions)
    rows = pipeline.transform(conversions)
    labels = indexer_labels(pipeline)
    if model_type == "dre":
        return Bundle(pipeline, labels, conf, model_type, robust=DoublyRobust(labels, propensity_model, seed=conf.seed, **options).fit(rows))
    mask = no_marketing_mask(marketing_mask(rows, catalog, conf))
    treated = sum(n.startswith(tuple(f"{t}_dummy" if bucketize else f"{t}_in_imp" for t in conf.treatments)) for n in attribute_names(rows))
    model = LiftRegression(restricted=treated).fit(rows)
    masked = PipelineModel(stages=[*pipeline.stages, mask])
    return Bundle(masked, labels, conf, model_type, regression=model)


@timed
def score(bundle: Bundle, conversions: DataFrame) -> DataFrame:
    """Per-row lift. A narrow plan: no shuffle, no cache."""
    rows = bundle.pipeline.transform(conversions)
    if bundle.model_type == "regression":
        return regression_output(bundle.regression.transform(rows))
    return robust_output(bundle.robust.score(rows), treatments_of(bundle.labels))


def summarize(bundle: Bundle, scored: DataFrame) -> DataFrame:
    """Prediction summary of a regression, effects of a doubly robust model."""
    if bundle.model_type == "regression":
        return prediction_summary(scored)
    return sinks.effects_table(scored.sparkSession, bundle.robust.effects)


@dataclass(kw_only=True)
class TrainingExecutorBuilder:
    """Training from locations, for callers that hold paths."""

    data_schema_location: str
    raw_data_location: str
    holidays_data_location: str
    s3_output_path: str
    bucket: str = ""
    do_bucketize: bool = False
    model_type: str = "regression"
    propensity_model_type: str = "LogisticRegression"
    options: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        check_choice(self.model_type, MODEL_TYPES, "model_type")
        check_choice(self.propensity_model_type, PROPENSITY_MODELS, "propensity_model_type")

    def build(self, spark: SparkSession) -> TrainingExecutor:
        catalog = readers.read_catalog(spark, self.data_schema_location)
        calendar = readers.read_calendar(spark, self.holidays_data_location, catalog.holiday_features)
        return TrainingExecutor(self, catalog, readers.read_conversions(spark, self.raw_data_location, calendar))


@dataclass
class TrainingExecutor:
    spec: TrainingExecutorBuilder
    catalog: SchemaCatalog
    conversions: DataFrame

    def run(self) -> Bundle:
        s, spark = self.spec, self.conversions.sparkSession
        bundle = train(self.conversions, self.catalog, model_type=s.model_type, propensity_model=s.propensity_model_type, bucketize=s.do_bucketize, **s.options)
        bundle.save(s.s3_output_path)
        if bundle.robust is not None:
            names = attribute_names(bundle.pipeline.transform(self.conversions))
            r = bundle.robust
            forests = {f"outcome_{n}": m for n, m in r.outcomes.items() if hasattr(m, "featureImportances")}
            sinks.write_models(spark, {"propensity_model": r.propensity.model, **forests}, names, s.s3_output_path)
            sinks.write_test_set(r.test.select("features", "treatment_type", "treatment_type_indexed", "conversionIndicator"), s.s3_output_path)
            sinks.write_artifact(sinks.effects_table(spark, r.effects), s.s3_output_path)
        return bundle


@dataclass
class DoublyRobustScoringExecutor:
    scoring_data_location: str
    holiday_data_location: str
    pipeline_data_location: str
    model_base_path: str
    output_data_location: str
    model_type: str = "dre"
    do_bucketize: bool = False
    calibrated: bool = True
    file_format: str = "parquet"

    def run_steps(self, spark: SparkSession) -> DataFrame:
        """Scores and writes; returns the written table."""
        bundle = Bundle.load(spark, self.model_base_path)
        rows = readers.read_conversions(spark, self.scoring_data_location, readers.read_calendar(spark, self.holiday_data_location))
        if self.pipeline_data_location and self.pipeline_data_location != self.model_base_path:
            bundle.pipeline = readers.load_pipeline(self.pipeline_data_location)
        scored = bundle.robust.score(bundle.pipeline.transform(rows), calibrated=self.calibrated)
        target = sinks.write_scored(robust_output(scored, treatments_of(bundle.labels)), self.output_data_location, self.file_format)
        return spark.read.format(self.file_format).options(**({"header": True} if self.file_format == "csv" else {})).load(target)


@dataclass
class RegressionScoringExecutor:
    scoring_data_location: str
    pipeline_data_location: str
    purchase_attribution_data_location: str

    def run_steps(self, spark: SparkSession) -> DataFrame:
        """Scores and writes; returns the written table. What it went by stays at hand as attributes."""
        self.bundle = Bundle.load(spark, self.pipeline_data_location)
        self.pipeline, self.model = self.bundle.pipeline, self.bundle.regression
        self.data = readers.with_defaults(readers.read_dataset(spark, self.scoring_data_location))
        self.scored = score(self.bundle, self.data)
        sinks.write_regression_scored(self.scored, self.purchase_attribution_data_location)
        return spark.read.parquet(self.purchase_attribution_data_location)


class ScoringPipeline:
    """Stages fitted in training, as one saved pipeline."""

    def __init__(self, stages: list, path: str) -> None:
        self.model, self.path = PipelineModel(stages=stages), path

    def persist(self) -> str:
        return sinks.write_pipeline(self.model, self.path)

    def get(self) -> PipelineModel:
        return self.model


class ModelBuilder:
    """Estimators by name."""

    @staticmethod
    def linear(conf: LiftConfig = LiftConfig(), restricted: int = 2) -> LiftRegression:
        return LiftRegression(weightCol="purchase_weight" if conf.weight else "intercept", restricted=restricted)

    @staticmethod
    def doubly_robust(labels: list[str], propensity_model: str = "RandomForest", **options) -> DoublyRobust:
        if CONTROL not in labels:
            raise ValueError(f"labels lack {CONTROL}")
        return DoublyRobust(labels, check_choice(propensity_model, PROPENSITY_MODELS, "propensity_model"), **options)

    @staticmethod
    def features(catalog: SchemaCatalog, **options) -> Pipeline:
        return feature_pipeline(catalog, **options)
