"""Layered lakehouse building blocks on plain PySpark.

Raw JSON lands by run, is conformed to a declared schema, upserted by key into a
snapshot table, verified, and aggregated into a mart. Each step is a DataFrame
operator that can be used on its own.
"""
