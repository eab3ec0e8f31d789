"""Operators for preparing training text: cleaning, duplicates, models, tokens, packing, shards.

Nothing else in the library imports this subpackage. Each module holds one operator with
its own general interface; ``queries`` applies them to the given tables.
"""
