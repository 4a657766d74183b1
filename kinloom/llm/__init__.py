"""Operators for large-scale training-data preparation.

Nothing outside this subpackage imports it. It uses nothing of the record engine but where
intermediate tables are kept (``kinloom.storage``).
"""
