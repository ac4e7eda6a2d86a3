"""The library's jobs bound to the given tables, each with its SQL counterpart."""
