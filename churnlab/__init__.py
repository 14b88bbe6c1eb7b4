"""churnlab: churn analytics as Spark DataFrame operators and ML stages.

Layout
------
sources/    readers and sinks (CSV, Parquet, JSON result records, models)
functions/  Column-level helpers (grades, key parsing, hashing, dates)
operators/  DataFrame operators: profiling, features, splits, models,
            evaluation, campaign targeting, guide extras
plans/      composed jobs: member table, preprocessing, sweep, campaign,
            and the query registry checked against DuckDB
streaming/  Structured Streaming variants of scoring and monitoring
"""

__version__ = "0.1.0"
