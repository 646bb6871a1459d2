"""Training-data operators: quality, deduplication, tokens, packing, chats, web archives.

Nothing else in the library imports this package. Every operator selects the columns it
needs by name and returns a fixed schema, so extra columns of its input never clash.
"""
