"""Spark table operators for sales and supply reporting.

Every function takes and returns DataFrames (or Columns) and chains with
``df.transform``. Nothing is run while a plan is put together; checks that must
fail a job are part of the plan itself or named ``assert_*``.
"""
