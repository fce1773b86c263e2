"""tidewater: analytics jobs written against Spark's public DataFrame, SQL,
ML and Structured Streaming APIs.

Every job is a plain function ``(spark, sf_dir) -> DataFrame`` registered in
``tidewater.plans.catalog``; the DuckDB statement that checks it lives next to
it.
"""

__version__ = "0.1.0"
