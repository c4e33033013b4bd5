"""Feature engineering, estimators, scoring, evaluation."""
