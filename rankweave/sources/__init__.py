"""Readers. Each takes a URI of any file system Spark knows."""
