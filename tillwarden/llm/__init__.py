"""Operators for training-data corpora: encoding, de-duplication, filters and search."""
