"""From prepared conversions to features: treatment labels, indicators, encodings."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import Bucketizer, ElementwiseProduct, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.config import BOTH, CONTROL, LiftConfig
from cairn.functions.columns import above, look_back_sum, purchase_weight
from cairn.sources.readers import SchemaCatalog

#: Feature names. Fixed values.
OUT_FEATURES = ("aap_out_imp_1", "aap_out_imp_7")
CUSTOMER_FEATURES = ("customerIsPrime", "customerPropensity_dummy", "customerRfm_dummy")
DAY_FEATURE = "day_of_week_dummy"


def indicator_name(treatment: str, days: int = 7) -> str:
    return f"{treatment}_in_imp_{days}"


def exposure_columns(df: DataFrame, conf: LiftConfig) -> DataFrame:
    """Look-back sums, treatment and out-impression indicators, prime flag, intercept, weight."""
    df = df.withColumns({f"{t}_sum": look_back_sum(f"{t}LinkIn", n) for t, n in conf.look_back.items()})
    own = {indicator_name(t, n): above(F.col(f"{t}_sum"), conf.imp_threshold) for t, n in conf.look_back.items()}
    own |= {"aap_out_imp_1": above(F.col("aapLinkOutD0"), 0), "aap_out_imp_7": above(look_back_sum("aapLinkOut", conf.out_days), 0)}
    own |= {"customerIsPrime": F.col("customerIsPrime").cast("int"), "intercept": F.lit(1), "purchase_weight": purchase_weight(df) if conf.weight else F.lit(1.0)}
    return df.withColumns(own)


def treatment_label(conf: LiftConfig):
    """The one treatment a row has, both_impressions for more, no_impression for none."""
    marks = {t: F.col(indicator_name(t, n)) for t, n in conf.look_back.items()}
    count = sum(marks.values(), F.lit(0))
    out = F.lit(CONTROL)
    for t, m in marks.items():
        out = F.when((m == 1) & (count == 1), t).otherwise(out)
    return F.when(count > 1, BOTH).otherwise(out)


def label_treatments(df: DataFrame, conf: LiftConfig = LiftConfig(), keep_both: bool = False) -> DataFrame:
    """Exposure columns, treatment_type, one-vs-rest flags; rows of both treatments are dropped."""
    out = exposure_columns(df, conf)
    if not keep_both:  # by the count: a filter on the label would be rewritten branch by branch
        out = out.filter(sum((F.col(indicator_name(t, n)) for t, n in conf.look_back.items()), F.lit(0)) < 2)
    out = out.withColumn("treatment_type", treatment_label(conf))
    return out.withColumns({f"is_treated_by_{t}": F.when(F.col("treatment_type") == t, 1.0).otherwise(0.0) for t in (*conf.treatments, CONTROL)})


def bucketize_exposure(df: DataFrame, conf: LiftConfig = LiftConfig()) -> DataFrame:
    """Left-closed exposure buckets 0..3 of every look-back sum, {t}_in_imp_{n}_bucket, cut at 0, the threshold and 200."""
    splits = [float("-inf"), 1e-5, float(conf.imp_threshold), 200.0, float("inf")]
    out = df.withColumns({f"{indicator_name(t, n)}_count": look_back_sum(f"{t}LinkIn", n).cast("int").cast("double") for t, n in conf.look_back.items()})
    for t, n in conf.look_back.items():
        out = Bucketizer(splits=splits, inputCol=f"{indicator_name(t, n)}_count", outputCol=f"{indicator_name(t, n)}_bucket", handleInvalid="keep").transform(out)
    return out


class _HasConfig(Params):
    config = Param(Params._dummy(), "config", "engine configuration as JSON", TypeConverters.toString)

    def conf(self) -> LiftConfig:
        return LiftConfig(**json.loads(self.getOrDefault(self.config)))


class ExposureTransformer(Transformer, _HasConfig, DefaultParamsReadable, DefaultParamsWritable):
    """label_treatments as a pipeline stage; bucketize adds the exposure buckets."""

    bucketize = Param(Params._dummy(), "bucketize", "add exposure buckets", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, config: str | None = None, bucketize: bool = False) -> None:
        super().__init__()
        self._setDefault(config=json.dumps(LiftConfig().__dict__), bucketize=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        conf = self.conf()
        out = label_treatments(dataset, conf)
        return bucketize_exposure(out, conf) if self.getOrDefault(self.bucketize) else out


class IndicatorTransformer(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Each input column becomes 1 where it exceeds its threshold, else 0; one threshold serves all."""

    thresholds = Param(Params._dummy(), "thresholds", "one for all or one per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, thresholds: list[float] | None = None) -> None:
        super().__init__()
        self._setDefault(thresholds=[0.0])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols, t = self.getInputCols(), self.getOrDefault(self.thresholds)
        t = t * len(cols) if len(t) == 1 else t
        if len(t) != len(cols):
            raise ValueError("thresholds: one, or as many as columns")
        return dataset.withColumns({c: above(F.col(c).try_cast("double"), x) for c, x in zip(cols, t, strict=True)}) if cols else dataset


def no_marketing_mask(mask: list[float], features: str = "features", out: str = "nm_features") -> ElementwiseProduct:
    """Features of a world without marketing: masked slots become 0."""
    return ElementwiseProduct(scalingVec=Vectors.dense(mask), inputCol=features, outputCol=out)


def feature_list(catalog: SchemaCatalog, conf: LiftConfig, model_type: str, propensity_model: str, bucketize: bool = False, day_of_week: bool | None = None) -> list[str]:
    """Assembler inputs in order. Linear models leave the weekday out unless asked; the
    regression starts with the intercept and ends with the treatment indicators, which the restricted fit relies on."""
    linear = model_type == "regression" or propensity_model == "LogisticRegression"
    with_day = not linear if day_of_week is None else day_of_week
    out = [*catalog.traffic_features, *catalog.holiday_features, *OUT_FEATURES, *CUSTOMER_FEATURES] + [DAY_FEATURE] * with_day
    if model_type == "regression":
        treated = [f"{t}_dummy" if bucketize else indicator_name(t, n) for t, n in conf.look_back.items()]
        out = ["intercept", *out, *treated]
    return out


def feature_pipeline(catalog: SchemaCatalog, conf: LiftConfig = LiftConfig(), model_type: str = "regression", propensity_model: str = "LogisticRegression", bucketize: bool = False, day_of_week: bool | None = None) -> Pipeline:
    """Exposure, indicators, indexers, encoders, assembler. Indexers are
    alphabetical, so labels do not depend on counts. Encoders leave out the last category, which the
    intercept holds; null or unseen categories of a customer raise."""
    names = feature_list(catalog, conf, model_type, propensity_model, bucketize, day_of_week)
    drop_last_day = model_type == "regression" or propensity_model == "LogisticRegression"
    stages = [
        ExposureTransformer(config=json.dumps(conf.__dict__), bucketize=bucketize),
        IndicatorTransformer(inputCols=list(catalog.traffic_features)),
        IndicatorTransformer(inputCols=list(catalog.holiday_features)),
        StringIndexer(inputCol="customerRfm", outputCol="customerRfm_indexed", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=["customerPropensityBucket", "customerRfm_indexed"], outputCols=["customerPropensity_dummy", "customerRfm_dummy"]),
    ]
    if DAY_FEATURE in names:
        stages += [StringIndexer(inputCol="day_of_week", outputCol="day_of_week_indexed", handleInvalid="keep", stringOrderType="alphabetAsc"), OneHotEncoder(inputCols=["day_of_week_indexed"], outputCols=[DAY_FEATURE], dropLast=drop_last_day, handleInvalid="keep")]
    if bucketize:
        stages.append(OneHotEncoder(inputCols=[f"{indicator_name(t, n)}_bucket" for t, n in conf.look_back.items()], outputCols=[f"{t}_dummy" for t in conf.treatments], handleInvalid="keep"))
    stages += [StringIndexer(inputCol="treatment_type", outputCol="treatment_type_indexed", stringOrderType="alphabetAsc"), VectorAssembler(inputCols=names, outputCol="features")]
    return Pipeline(stages=stages)


def fit_pipeline(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """The pipeline fitted in one pass over df: its estimators (indexers and encoders, alphabetical) need
    no more than which values stand together in their input columns, so they are fitted on
    those distinct rows alone, which are as few as the categories are."""
    stages, made, needed, own = pipeline.getStages(), df, [], set()
    for s in stages:
        if isinstance(s, Estimator):
            ins = s.getInputCols() if s.isDefined("inputCols") else [s.getInputCol()]
            own |= set(s.getOutputCols() if s.isDefined("outputCols") else [s.getOutputCol()])
            needed += [c for c in ins if c not in own and c not in needed]
        elif not isinstance(s, VectorAssembler):
            made = s.transform(made)
    categories = made.select(*needed).distinct().persist()
    try:
        rows, fitted = categories, []
        for s in stages:
            if isinstance(s, Estimator):
                s = s.fit(rows)
                rows = s.transform(rows)
            fitted.append(s)
        return PipelineModel(stages=fitted)
    finally:
        categories.unpersist()


def attribute_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names of the vector's slots in order, whatever groups the metadata has."""
    attrs = df.schema[features].metadata["ml_attr"].get("attrs", {})
    return [a["name"] for a in sorted((a for group in attrs.values() for a in group), key=lambda a: a["idx"])]


def marketing_mask(df: DataFrame, catalog: SchemaCatalog, conf: LiftConfig, features: str = "features") -> list[float]:
    """Ones, but 0 at the numeric slots that marketing and treatment columns fill."""
    meta = df.schema[features].metadata["ml_attr"]
    masked = {*catalog.marketing_features, *(indicator_name(t, n) for t, n in conf.look_back.items())}
    mask = [1.0] * meta["num_attrs"]
    for a in meta.get("attrs", {}).get("numeric", []):
        if a["name"] in masked:
            mask[a["idx"]] = 0.0
    return mask


def indexer_labels(model: PipelineModel, output: str = "treatment_type_indexed") -> list[str]:
    """Labels of the pipeline's indexer with that output, by index."""
    for s in model.stages:
        if isinstance(s, StringIndexerModel) and s.getOutputCol() == output:
            return list(s.labels)
    raise ValueError(f"the pipeline has no indexer of {output}")


def treatments_of(labels: list[str]) -> list[str]:
    out = [x for x in labels if x != CONTROL]
    if not out:
        raise ValueError("no treated rows")
    return out


def assembled_columns(model: PipelineModel) -> list[str]:
    """Inputs of the pipeline's assembler."""
    return next(s.getInputCols() for s in model.stages if isinstance(s, VectorAssembler))


class FeatureEngineering:
    """Features of prepared conversions, with what they were made by."""

    def __init__(self, conversions: DataFrame, catalog: SchemaCatalog, conf: LiftConfig = LiftConfig(), model_type: str = "regression", propensity_model: str = "LogisticRegression", bucketize: bool = False) -> None:
        self.processed, self.catalog, self.conf = conversions, catalog, conf
        self.pipeline: PipelineModel = fit_pipeline(feature_pipeline(catalog, conf, model_type, propensity_model, bucketize), conversions)
        self.featurized = self.pipeline.transform(conversions)

    @property
    def labels(self) -> list[str]:
        return indexer_labels(self.pipeline)

    @property
    def names(self) -> list[str]:
        return attribute_names(self.featurized)
