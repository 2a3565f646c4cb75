"""Propensity analytics on Spark: feature tables, imputation, splits, statistics,
training, scoring and metrics as DataFrame functions."""

from strataprop.operators.exploration import (
    bin_2d,
    box_stats,
    chi_square,
    contingency,
    correlation_matrix,
    sample_points,
)
from strataprop.operators.features import category_index, feature_columns
from strataprop.operators.imputation import (
    Impute,
    apply_imputation,
    fit_imputation,
    imputation_params,
    params_from_values,
)
from strataprop.operators.joins import equi_join, feature_table
from strataprop.operators.metrics import binary_metrics, metrics_dict, metrics_long
from strataprop.operators.model_files import open_model, remove_model, save_model
from strataprop.operators.quantiles import exact_quantiles
from strataprop.operators.scoring import score, score_python
from strataprop.operators.splitting import (
    split_by_hash,
    split_by_sampling,
    split_counts,
    train_validation,
)
from strataprop.operators.training import evaluate, fit_classifier

__all__ = [
    "Impute",
    "apply_imputation",
    "bin_2d",
    "binary_metrics",
    "box_stats",
    "category_index",
    "chi_square",
    "contingency",
    "correlation_matrix",
    "equi_join",
    "evaluate",
    "exact_quantiles",
    "feature_columns",
    "feature_table",
    "fit_classifier",
    "fit_imputation",
    "imputation_params",
    "metrics_dict",
    "metrics_long",
    "open_model",
    "params_from_values",
    "remove_model",
    "sample_points",
    "save_model",
    "score",
    "score_python",
    "split_by_hash",
    "split_by_sampling",
    "split_counts",
    "train_validation",
]
