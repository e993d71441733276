"""Column-to-column functions; none of them shuffles."""
