"""Column-to-column functions. All of them stay inside Spark's generated code."""
