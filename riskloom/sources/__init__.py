"""Readers and writers for the raw files and the produced tables."""
