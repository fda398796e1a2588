"""Stock-count analytics as PySpark DataFrame operators."""
