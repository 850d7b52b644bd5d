"""Operators of a training-data pipeline over text and embeddings. Nothing else in the package imports this subpackage."""
