"""Operators for training-data pipelines: text extraction, counting, cleaning, mixing."""
