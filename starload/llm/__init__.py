"""Operators that prepare corpora for training: nothing else in the library imports them."""
