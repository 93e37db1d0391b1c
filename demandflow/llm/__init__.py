"""Operators for preparing text corpora; nothing else of the package imports them."""
