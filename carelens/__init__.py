"""carelens — hospital-claims analytics as Spark DataFrame operators.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects and is
expressed with built-in Spark SQL functions so that Catalyst can prune,
push down and plan the shuffles.  See README.md for the module map.
"""

__version__ = "0.1.0"
