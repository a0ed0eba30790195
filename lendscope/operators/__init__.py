"""Reusable relational operators."""
from .aggspec import AggSpec, aggregate, stat_expr
from .encode import (label_codes, label_encode, one_hot, string_columns, target_encode_oof,
                     target_fit, target_fit_transform, target_transform, vocabulary)
from .series import (attach_group_stats, group_median, gap_to_previous, prefix_sums,
                     quantile_bucket, uniform_bucket)

__all__ = ["AggSpec", "aggregate", "stat_expr", "label_codes", "label_encode", "one_hot",
           "string_columns", "target_encode_oof", "target_fit", "target_fit_transform",
           "target_transform", "vocabulary", "gap_to_previous",
           "prefix_sums", "attach_group_stats", "group_median", "quantile_bucket", "uniform_bucket"]
