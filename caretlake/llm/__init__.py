"""Operators that prepare texts for training language models; nothing else in the library imports this subpackage."""
