"""Operators for training data: duplicates, subjects, tokens, packing and splitting."""
