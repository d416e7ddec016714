"""Member analytics on Spark.

Every data product is a function from DataFrames to a DataFrame, built from
native Spark expressions, joins, aggregations and windows. Nothing is collected
to the driver; callers decide where results go (``memberscope.sources.sinks``).

Sub-packages:

- ``sources``   – table loading, the domain views over the shared tables, text
                  lines, and sinks.
- ``functions`` – column-level helpers: money, calendar, audience rules.
- ``operators`` – the data products (distributions, funnel, growth, hot words,
                  member tags, audience selection, calendar table jobs).
- ``plans``     – the registered queries and their SQL oracle.
- ``streaming`` – the daily-count product over a streaming source.
"""

from memberscope.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
