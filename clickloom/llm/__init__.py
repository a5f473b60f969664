"""Training-data operators: scans, filters, near-duplicates, search, mixing, encoding.

Nothing outside this subpackage imports it.
"""
