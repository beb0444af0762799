"""Operators for preparing training text: filters, searches, de-duplication, counting and packing."""
