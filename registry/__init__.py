"""The checked queries: test tables, Spark side and SQL side."""
