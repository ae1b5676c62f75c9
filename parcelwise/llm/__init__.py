"""Operators for preparing training data of language models."""
