"""Source-repository analytics on PySpark."""
