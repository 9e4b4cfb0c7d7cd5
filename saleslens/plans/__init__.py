"""The batch pipeline, the registered queries and their SQL counterparts."""
