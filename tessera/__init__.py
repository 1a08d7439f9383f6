"""tessera: a PySpark-native engine for tabular analytics, array maths and a
binary-classification workflow.

Every operator is a Spark DataFrame job: a lazy plan that Catalyst optimises
and the cluster executes.  Small driver-side steps are limited to data whose
size is bounded by a parameter (a threshold grid, a bucket table, a category
list with a cap), never by the input size.
"""

from tessera.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
