"""Retail medallion analytics on Spark: bronze feeds, silver tables, gold marts."""
