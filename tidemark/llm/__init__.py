"""Operators of a training-data pipeline on document, embedding and file tables."""
