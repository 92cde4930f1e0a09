"""The engine's queries over the given test tables, and their SQL counterparts."""
