"""Column-to-Column building blocks and the declared schemas."""
