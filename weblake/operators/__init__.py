"""DataFrame-level operators Spark has no single primitive for."""
