"""Column-level building blocks: profiles, derived columns, exact ranks."""
