"""Per-treatment outputs of scoring, and typed summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.config import COMMON_COLUMNS, LIFT_FIELDS, REGRESSION_COLUMNS

from .propensity import column_of


def incremental(lift: str, value: str = "conversionOps") -> F.Column:
    return F.col(lift) * F.col(value)


def robust_output(scored: DataFrame, treatments: list[str]) -> DataFrame:
    """The common columns; per treatment its propensity, outcome, AIPW parts and lift; miops_{T} = lift x conversionOps."""
    own = [c for t in treatments for c in (column_of(t), f"normalized_{column_of(t)}", f"{t}_probability", f"{t}_factual", f"{t}_counterfactual", f"{t}_dre", f"{t}_lift") if c in scored.columns]
    return scored.select(*[c for c in COMMON_COLUMNS if c in scored.columns], *own, *[incremental(f"{t}_lift").alias(f"miops_{t.upper()}") for t in treatments])


def regression_output(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """REGRESSION_COLUMNS: the flattened lift struct and incremental values by each lift."""
    flat = scored.select(*[c for c in scored.columns if c not in (prediction, "conversionType")], F.lit("orderItem").alias("conversionType"), *[F.col(f"{prediction}.{c}") for c in LIFT_FIELDS])
    miops = {f"miops{x}": incremental(f"lift{x}") for x in ("Wb", "MlaGnuA", "MlaGnuB")}
    return flat.withColumns(miops).select(*REGRESSION_COLUMNS)
