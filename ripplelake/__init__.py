"""Medallion analytics for change-event streams on Spark.

Messages flow bronze -> silver -> gold.  Every step is a pure
``DataFrame -> DataFrame`` function, shared by micro-batches, backfill and replay.
"""
