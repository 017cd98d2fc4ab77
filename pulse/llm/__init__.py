"""Operators on text corpora, web pages and vectors. Nothing else in the package imports them."""
