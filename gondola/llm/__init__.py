"""Operators for preparing text corpora for language-model training."""
