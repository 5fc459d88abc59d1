"""recsql: a Spark-native recommendation-analytics engine.

Every public function takes and returns Spark DataFrames; the heavy work
(joins, aggregations, windows, blocked linear algebra) runs on executors.
"""

__all__ = ["session", "sources", "functions", "operators", "models", "plans"]
