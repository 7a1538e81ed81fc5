"""Column-to-Column functions; every one is built from native Spark expressions."""
