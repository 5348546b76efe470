"""DataFrame transformations: sessions, state, change logs, trends, digests, blocks, surveys."""
