"""proplens: tabular-regression data preparation and evaluation on Spark.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column``) so that a whole workflow stays one lazy plan that Catalyst can
optimise and Spark can distribute.
"""

from proplens.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
__version__ = "0.1.0"
