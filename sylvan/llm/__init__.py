"""Operators for preparing language-model training data, as Spark jobs.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` holds the thin registered
queries over the driver's tables.
"""
