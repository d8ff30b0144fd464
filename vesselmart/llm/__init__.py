"""Training-data operators: filters, formatting, tokenising, deduplication.

Nothing else in the library imports this subpackage.
"""
