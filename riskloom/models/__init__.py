"""Spark ML stages."""
