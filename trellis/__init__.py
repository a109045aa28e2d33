"""Graph and text analytics on PySpark."""
