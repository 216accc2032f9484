"""Warehouse models, marts and reports composed of operators."""
