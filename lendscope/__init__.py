"""lendscope — Spark-native credit-risk feature and scoring engine.

Sub-packages
------------
sources    readers, role views over the input tables, sinks
functions  column expressions (null-safe arithmetic, row-wise statistics, hashing)
operators  reusable relational operators (aggregation specs with cohorts, encoders,
           skew-safe ordered windows, profiling, folds and exact metrics)
plans      the domain feature builders composed from the operators
llm        operators of a training-data pipeline (optional, nothing else imports it)
"""

__version__ = "0.1.0"
