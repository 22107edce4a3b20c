"""Operators that prepare text for training, apart from the rest of the library."""
