"""Spark-native analytics: sources, relational operators, sales tables, quality checks and corpus preparation."""
