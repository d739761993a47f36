"""The registered queries, their SQL counterparts and the timing tools."""
