"""DataFrame transforms; none of them writes or collects data."""
