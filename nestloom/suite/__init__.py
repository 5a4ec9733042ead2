"""The registered queries: roles the given tables play, the Spark queries, and their SQL counterparts."""
