"""Retail lakehouse jobs on PySpark: incremental mirror, star schema, quality checks and reports."""
