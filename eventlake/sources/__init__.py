"""Streams and tables to read from."""
