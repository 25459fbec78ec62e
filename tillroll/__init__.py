"""tillroll: retail transaction-line marts on Spark.

Raw lines (CSV or Parquet) go through a Bronze copy, a Silver layer
(dedup, clean, classify, quality filter) and four Gold marts (daily,
product, customer, country) with exact decimal measures and
deterministic revenue ranks; a validation pass reconciles the marts with
Silver. Every step is a DataFrame-in, DataFrame-out function so Catalyst
sees the whole plan.
"""

from tillroll.schemas import RAW_COLUMNS, RAW_SCHEMA

__all__ = ["RAW_COLUMNS", "RAW_SCHEMA"]
