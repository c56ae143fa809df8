"""Column-level building blocks: native expressions only, no row-at-a-time Python."""
