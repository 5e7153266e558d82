"""DataFrame transforms."""
