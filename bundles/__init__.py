"""bundles: a Spark-native collection / basket recommendation engine.

Every operator takes and returns a ``pyspark.sql.DataFrame``; the heavy work
is expressed with DataFrame / SQL operators so Catalyst and AQE choose the
physical plan.  Python runs on executors only where order-dependent state
needs it (collection packing) or for small dense solves (EASE blocks).
"""

__version__ = "0.1.0"
