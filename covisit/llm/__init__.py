"""Operators for large-scale training data: filtering, deduplication, decontamination and output formats.

Nothing else in the library imports this subpackage.
"""
