"""Query registry: whole-table queries and their SQL counterparts."""
