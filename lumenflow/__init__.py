"""lumenflow: customer enrichment and table-history operators on Spark.

Every operator is a plain DataFrame -> DataFrame function built from
``pyspark.sql`` primitives; sources and sinks are thin shells around
``spark.read`` / ``df.write`` / ``writeStream``.
"""

__version__ = "0.1.0"
