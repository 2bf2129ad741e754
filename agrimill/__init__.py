"""Reference-data refinery for farming data sets, written as Spark DataFrame jobs.

Every operator takes and returns DataFrames (or Columns) and stays lazy: Catalyst
plans the work and the executors run it.
"""
