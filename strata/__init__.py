"""strata: Spark-native student-analytics and document-analytics operators.

Every operator takes and returns Spark ``DataFrame``/``Column`` objects and is
built from Catalyst expressions, so one plan covers scan to result.
"""

__version__ = "0.1.0"
