"""Operators for preparing training text: filters, language, deduplication, decontamination, storage, packing.

Nothing else in the library imports this package.
"""
