"""Operators for text corpora; nothing outside this subpackage imports it."""
