"""Thresholds shared by the operators, in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    random_seed: int = 42
    cv_folds: int = 5
    sla_threshold_minutes: float = 40.0
    reliability_w_rating: float = 0.4
    reliability_w_sentiment: float = 0.3
    reliability_w_delay: float = 0.3
    hybrid_weight_content: float = 0.4
    hybrid_weight_collaborative: float = 0.3
    hybrid_weight_reliability: float = 0.3
    drift_ks_threshold: float = 0.05
    drift_feature_sample: int = 100
    drift_alert_cooldown_hours: float = 24.0
    retrain_cooldown_hours: float = 6.0
    retrain_drift_fraction: float = 0.3
    eta_risk_minutes: float = 40.0
    default_budget: float = 500.0


DEFAULTS = Settings()
