"""carelake: Spark-native operators and plans for outpatient-clinic analytics.

Everything is a DataFrame -> DataFrame transformation built from Spark SQL
built-in functions; nothing is collected to the driver inside an operator.
"""

from carelake.session import get_spark, work_dir  # noqa: F401

__all__ = ["get_spark", "work_dir"]
