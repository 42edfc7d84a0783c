"""Jobs and their registry."""
