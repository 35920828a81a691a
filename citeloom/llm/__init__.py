"""Operators for building training data out of bibliographic tables.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries only if it can be imported.
"""
