"""alertlens: alert prioritization over transaction histories on Spark.

Subpackages: ``sources`` (inputs and artifacts), ``functions`` (column
helpers), ``operators`` (history preparation, features, ordered scan, ranks,
folds, imputation, EDA, blending, result checks), ``plans`` (Spark ML models,
cross-validation, selection, drift, tuning, integrity, end-to-end runs and the
registered queries), ``streaming`` (none: the reference has no streams).
"""
__version__ = "0.1.0"
