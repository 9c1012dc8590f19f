"""Operators for training-data corpora, one module per operator, and their registered queries."""
