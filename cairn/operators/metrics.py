"""Classification metrics from one confusion-matrix aggregate, areas, and the prediction summary."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.config import LIFT_FIELDS

from . import sampling


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")).agg(F.count("*").alias("n"))


def class_metrics(matrix: DataFrame) -> DataFrame:
    """(label, support, precision, recall, f1) of every class that occurs; 0 where undefined."""
    as_label = matrix.groupBy("label").agg(F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("hit"))
    as_guess = matrix.groupBy(F.col("prediction").alias("guess")).agg(F.sum("n").alias("guessed"))
    both = as_label.join(as_guess, F.col("label") == F.col("guess"), "full").select(F.coalesce("label", "guess").alias("label"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("support", "hit", "guessed")])
    p, r = F.coalesce(F.try_divide("hit", "guessed"), F.lit(0.0)), F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    return both.select("label", "support", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"))


def weighted_metrics(matrix: DataFrame) -> DataFrame:
    """(accuracy, f1, weightedPrecision, weightedRecall), classes weighted by support, rounded to 5."""
    c = class_metrics(matrix)
    mean = lambda x: F.round(F.try_divide(F.sum(F.col(x) * F.col("support")), F.sum("support")), 5)
    return c.agg(mean("recall").alias("accuracy"), mean("f1").alias("f1"), mean("precision").alias("weightedPrecision"), mean("recall").alias("weightedRecall"))


def binary_areas(df: DataFrame, label: str, raw: str = "rawPrediction") -> dict[str, float]:
    return {n: round(BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName=n).evaluate(df), 5) for n in ("areaUnderROC", "areaUnderPR")}


def binary_metrics(df: DataFrame, label: str, prediction: str = "prediction", raw: str = "rawPrediction") -> dict[str, float]:
    return binary_areas(df, label, raw) | weighted_metrics(confusion(df, label, prediction)).first().asDict()


def multiclass_metrics(df: DataFrame, label: str, labels: list[str], prediction: str = "prediction") -> tuple[dict[str, dict], dict[str, float]]:
    """Metrics by class name, and weighted ones."""
    matrix = confusion(df, label, prediction)
    by = {labels[int(r.label)]: {k: round(r[k], 5) for k in ("precision", "recall", "f1")} for r in class_metrics(matrix).collect()}
    return by, weighted_metrics(matrix).first().asDict()


_PLACES = (0.5, 0.25, 0.1, 0.75, 0.9)


def prediction_summary(df: DataFrame, fields: tuple[str, ...] = LIFT_FIELDS) -> DataFrame:
    """One row a prediction column, by name: min, max, mean, sd, skewness (third central
    moment over sd^3), skewness_ref (over sd^6), percentiles, shares <= 0 and >= 1, all exact at any
    size and of the values that are not null; a column without values has no row. One pass gives the counts
    and moments of all columns; where no column has more than EXACT_ROWS values a second
    gives all percentiles, else the places of all columns are narrowed down together."""

    def moments(c: str) -> Column:
        v = F.col(f"`{c}`").cast("double")
        third = F.avg(F.pow(v, F.lit(3))) - 3 * F.avg(v) * F.avg(F.pow(v, F.lit(2))) + 2 * F.pow(F.avg(v), F.lit(3))
        sd, share = F.stddev_samp(v), lambda x: F.avg(x.cast("double"))
        return F.struct(F.lit(c).alias("variable"), F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), sd.alias("sd"), F.try_divide(third, F.pow(sd, F.lit(3))).alias("skewness"),
                        F.try_divide(third, F.pow(sd, F.lit(6))).alias("skewness_ref"), share(v <= 0).alias("negative_frac"), share(v >= 1).alias("oneplus_frac")).alias(c)

    found = {r.variable: r for r in df.agg(*[moments(c) for c in fields]).first() if r.n}
    if all(r.n <= sampling.EXACT_ROWS for r in found.values()):
        row = df.agg(*[F.percentile(F.col(f"`{c}`").cast("double"), list(_PLACES)).alias(c) for c in found]).first() if found else {}
        places = {c: row[c] for c in found}
    else:
        places = sampling.column_percentiles(df, list(_PLACES), {c: r.n for c, r in found.items()})
    names = ["min", "max", "mean", "sd", "skewness", "skewness_ref"]
    rows = [(c, *[r[k] for k in names], *places[c], r.negative_frac, r.oneplus_frac) for c, r in found.items()]
    columns = [*names, *[f"p{int(100 * x)}" for x in _PLACES], "negative_frac", "oneplus_frac"]
    return df.sparkSession.createDataFrame(rows, "variable string, " + ", ".join(f"{c} double" for c in columns))


def transposed(summary: DataFrame) -> DataFrame:
    """The summary with a row for each statistic and a column for each variable."""
    stats = [c for c in summary.columns if c != "variable"]
    return summary.unpivot(["variable"], stats, "statistic", "value").groupBy("statistic").pivot("variable", list(LIFT_FIELDS)).agg(F.first("value"))
