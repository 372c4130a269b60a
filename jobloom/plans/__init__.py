"""Session settings, shared storage and the query registry."""
