"""Operators for preparing training text: filters, deduplication, packing and archives."""
