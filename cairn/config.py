"""Names, constants and switches of the lift engine."""

from __future__ import annotations

from dataclasses import dataclass, field

CONTROL = "no_impression"
BOTH = "both_impressions"
#: Order and names of the per-row lift output. Fixed values.
LIFT_FIELDS = ("liftWb", "liftWbStandardError", "liftMlaGnuA", "liftMlaGnuB", "pDenomMlaGnuA", "pDenomMlaGnuB", "pNumMlaGnuA", "pNumMlaGnuB")
#: Columns that every scored table carries. Fixed values.
COMMON_COLUMNS = ("adUserId", "conversionCurrency", "conversionOps", "conversionIndicator", "treatment_type", "treatment_type_indexed")
#: Columns of the regression's scored table, in order. Fixed values.
REGRESSION_COLUMNS = ("adUserId", "conversionType", "conversionCurrency", *LIFT_FIELDS, "miopsWb", "miopsMlaGnuA", "miopsMlaGnuB")

#: Parameters of the propensity models, of their calibration and of the outcome model. Fixed values.
LOGISTIC = {"family": "multinomial", "maxIter": 250, "regParam": 0.016, "elasticNetParam": 0.5}
FOREST = {"numTrees": 150, "maxDepth": 15, "minInstancesPerNode": 10, "maxBins": 32, "featureSubsetStrategy": "sqrt", "subsamplingRate": 0.9, "impurity": "gini"}
PLATT = {"regParam": 0.015, "elasticNetParam": 1.0}
OUTCOME_FOREST = {"numTrees": 50, "maxDepth": 10, "minInstancesPerNode": 20, "subsamplingRate": 0.8, "featureSubsetStrategy": "sqrt", "impurity": "gini"}

MODEL_TYPES = ("regression", "dre")
PROPENSITY_MODELS = ("LogisticRegression", "RandomForest")


@dataclass(frozen=True)
class LiftConfig:
    """look_back: days of impressions that count for each treatment; a user is treated
    if their sum exceeds imp_threshold; weight: weigh conversions by 1 / item count."""

    look_back: dict[str, int] = field(default_factory=lambda: {"ada": 7, "aap": 7})
    imp_threshold: int = 5
    weight: bool = True
    out_days: int = 7
    seed: int = 12345

    @property
    def treatments(self) -> list[str]:
        return list(self.look_back)

    def __post_init__(self) -> None:
        if not self.look_back or any(n < 1 for n in self.look_back.values()):
            raise ValueError("every treatment needs a look-back of a day or more")


def check_choice(value: str, choices: tuple[str, ...], what: str) -> str:
    if value not in choices:
        raise ValueError(f"{what} must be one of {', '.join(choices)}, not {value!r}")
    return value
