"""Retail-warehouse and near-duplicate operators for PySpark.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns.  Nothing here collects data; the few places that run a Spark action
(reading file headers, writing a table, choosing a mirror) say so.
"""
