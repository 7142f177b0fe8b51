"""Operators of a training-data pipeline over a table of documents. Nothing outside this folder imports it."""
