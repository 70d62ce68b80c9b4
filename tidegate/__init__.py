"""Data-pipeline operators for tables and streams, as plain PySpark.

Every operator takes and returns DataFrames or Columns, so Catalyst plans the
work and adaptive execution sizes it.
"""
