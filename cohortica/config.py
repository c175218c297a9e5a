"""Thresholds and weights of the segmentation workflow, all in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # audit
    high_missing_pct: float = 50.0
    id_unique_pct: float = 95.0
    id_least_values: int = 20
    ordinal_values: int = 10
    categorical_values: int = 20
    example_values: int = 8
    levels_shown: int = 100
    # screening and feature quality
    segmentation_missing_pct: float = 40.0
    least_unique: int = 2
    least_sd: float = 1e-8
    high_correlation: float = 0.80
    least_per_group: int = 1
    # feature scores
    pca_share: float = 0.80
    bootstrap_rounds: int = 100
    score_pca: float = 0.50
    score_entropy: float = 0.20
    score_stability: float = 0.20
    score_unique: float = 0.10
    feature_counts: tuple[int, ...] = (23, 20, 18, 15, 12)
    # models
    sample_rows: int = 2000
    sample_pairs: int = 100_000
    k_values: tuple[int, ...] = (2, 3, 4, 5, 6, 7, 8)
    validated_k: tuple[int, ...] = (3, 4, 5, 6)
    validated_models: int = 30
    kmeans_starts: int = 100
    kmeans_steps: int = 200
    least_share: float = 0.05
    model_weights: tuple[float, ...] = (0.45, 0.20, 0.15, 0.20)
    stable_jaccard: float = 0.60
    good_jaccard: float = 0.75
    resample_share: float = 0.80
    gap_rounds: int = 50
    validation_weights: tuple[float, ...] = (0.30, 0.35, 0.15, 0.10, 0.10)
    candidate_models: int = 6
    candidate_tolerance: float = 0.20
    final_weights: tuple[float, ...] = (0.45, 0.30, 0.15, 0.10)
    # profiles and rules
    significance: float = 0.05
    top_features: int = 4
    strong: float = 0.50
    moderate: float = 0.25
    key_variables: int = 20
    seed: int = 123


SETTINGS = Settings()

#: Texts that stand for a missing answer, and for yes and no.
MISSING_TOKENS = ("", "NA", "N/A", "n/a", "NULL", "null", "Missing", "missing", "Not stated", "Prefer not to say")
YES = ("yes", "y", "true", "1", "selected")
NO = ("no", "n", "false", "0", "not selected")
TRUE_WORDS = ("true", "t", "yes", "y", "1")
FALSE_WORDS = ("false", "f", "no", "n", "0")
ROLES = ("metadata", "segmentation", "profiling")
DATA_TYPES = ("identifier", "numeric", "ordinal", "binary", "categorical", "text")
