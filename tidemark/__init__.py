"""Analytics jobs for tables and streams on PySpark."""
