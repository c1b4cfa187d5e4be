"""Operators that prepare text for training: each a DataFrame in, a DataFrame out."""
