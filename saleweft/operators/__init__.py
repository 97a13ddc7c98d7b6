"""Table operators by family."""
