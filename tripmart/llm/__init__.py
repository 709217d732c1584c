"""Operators for training data: tokens, packing, quality, licenses, languages, near copies, private data, vectors."""
