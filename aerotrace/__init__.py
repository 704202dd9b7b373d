"""aerotrace: PySpark-native analytics for aircraft telemetry.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` so Catalyst can prune, push down and codegen it.
"""

__version__ = "0.1.0"
