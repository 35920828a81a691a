"""citeloom: processing of bibliographic tables with PySpark."""
