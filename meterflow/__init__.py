"""meterflow — usage, CRM and price-tick datasets as PySpark DataFrame jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, so Catalyst plans it (pushdown, pruning, partial
aggregation, AQE) and the same code runs in batch and Structured Streaming.
"""

__version__ = "0.1.0"
