"""Operators for preparing training data: texts in, decisions, tokens or cleaned texts out."""
