"""Spark jobs for gridded environmental data."""
