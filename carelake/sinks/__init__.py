"""Table mutation (K1-K17) and incremental-load control."""
