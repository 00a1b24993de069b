"""Training-data operators: web archives, filters, deduplication, tokens, shards.

Nothing outside this subpackage imports it.  Each module is one operator with
its own general interface; ``queries.py`` applies the operators to the given
tables and derives the digest columns of the registered queries.
"""
