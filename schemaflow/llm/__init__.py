"""Operators for large text corpora, each with its query; nothing outside this subpackage imports it."""
