"""Operators over texts and names for training corpora. Nothing else in the library imports this package."""
