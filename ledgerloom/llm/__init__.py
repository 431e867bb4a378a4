"""Operators that prepare text for training: duplicates, noise, history, names, private data, packing, leaks, subjects."""
