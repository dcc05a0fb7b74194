"""Operators that turn a raw corpus into training data; nothing else in the library imports this subpackage."""
