"""Ranking analytics over periodic content snapshots, as Spark DataFrame jobs."""
