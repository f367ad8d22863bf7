"""Spark-native analytics engine for a medallion learning-platform warehouse.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns).  Nothing here collects rows to the driver; Catalyst plans the work.
"""
