"""DataFrame operators; each takes and returns a DataFrame and runs no action."""
