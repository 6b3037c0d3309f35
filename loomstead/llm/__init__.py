"""Operators for building training data from document tables, on plain Spark.

Nothing outside this package imports it, apart from the guarded registration in
``__spark_entry__``.
"""
