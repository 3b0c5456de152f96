"""Jobs composed from the operators."""
