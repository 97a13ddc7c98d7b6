"""Business results composed from the operators."""
