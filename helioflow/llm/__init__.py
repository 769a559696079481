"""Operators for building text corpora; nothing else in the library imports this subpackage."""
