"""Training-data operators: sharding, search, scanning, language ID, tokenising, deduplication.

Nothing else in the library imports this subpackage.
"""
