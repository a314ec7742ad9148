"""tabflow: the data work around a tabular classifier, as Spark jobs.

Subpackages
-----------
sources    file scans, catalog tables, feature table, prediction appends
functions  column expressions (casts, label maps, name clean-up, hash buckets)
operators  encoders, scalers, splits, metrics, model pipeline, Shapley,
           run/version tables, data-quality checks
plans      derived fixtures, the query catalog, its DuckDB oracle, the flows
streaming  incremental batch scoring with exactly-once appends

The common operators are importable from the top level, e.g.
``from tabflow import OneHot, hash_split, binary_metrics``.
"""

from tabflow.functions.columns import (check_description, clean_names, drop_nulls, fill_constant,
                                       flag_correct, hash_bucket, map_label, to_double)
from tabflow.operators.checks import check_key, check_predicts, check_schema
from tabflow.operators.encode import OneHot, OneHotModel, one_hot
from tabflow.operators.metrics import (accuracy, binary_metrics, pr_auc, roc_auc, roc_pr_auc,
                                       slice_accuracy, slice_gate)
from tabflow.operators.model import (assemble, hash_text, load_model, save_model, score,
                                     train_baseline, train_production)
from tabflow.operators.registry import (current_stage, current_tags, find_release, gate,
                                        latest_versions, leaderboard, log_run, select_run, versions)
from tabflow.operators.scale import impute_mean, standardize
from tabflow.operators.shapley import impute_mode, shapley
from tabflow.operators.split import hash_split, sample_n, smoke_rows, stratified_split
from tabflow.sources.files import read_csv_fixed, read_csv_inferred, read_parquet
from tabflow.sources.tables import (append_predictions, ensure_database, read_table, reset_database,
                                    write_external_table, write_feature_table, write_table)

__version__ = "0.1.0"

__all__ = [
    "OneHot", "OneHotModel", "accuracy", "append_predictions", "assemble", "binary_metrics",
    "check_description", "check_key", "check_predicts", "check_schema", "clean_names", "current_stage",
    "current_tags", "drop_nulls", "ensure_database", "fill_constant", "find_release", "flag_correct",
    "gate", "hash_bucket", "hash_split", "hash_text", "impute_mean", "impute_mode", "latest_versions",
    "leaderboard", "load_model", "log_run", "map_label", "one_hot", "pr_auc", "read_csv_fixed",
    "read_csv_inferred", "read_parquet", "read_table", "reset_database", "roc_auc", "roc_pr_auc",
    "sample_n", "save_model", "score", "select_run", "shapley", "slice_accuracy", "slice_gate",
    "smoke_rows", "standardize", "stratified_split", "to_double", "train_baseline", "train_production",
    "versions", "write_external_table", "write_feature_table", "write_table",
]
