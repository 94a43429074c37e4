"""Queries over the given tables, their SQL counterparts and the adapters between them."""
