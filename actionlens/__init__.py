"""actionlens: behaviour-log feature and conversion analytics on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, aggregates, joins and windows.  Nothing in the data
path collects to the driver.
"""

__all__ = ["session", "params"]
