"""Training-data operators: filters, deduplication, sharding and tokenisation.

Nothing else in the library imports this subpackage.
"""
