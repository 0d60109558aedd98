"""Medallion analytics on Spark: snapshots in, typed history and current state out."""
