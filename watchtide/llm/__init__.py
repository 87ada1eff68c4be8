"""Operators for preparing training text: scans, filters, de-duplication, mixing, sharding, archives and search."""
