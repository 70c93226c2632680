"""Tallywork: table and stream summaries written as plain PySpark.

Every helper takes and returns DataFrames or Columns. Nothing here pulls rows to
the driver except values whose size is bounded and checked first.
"""
