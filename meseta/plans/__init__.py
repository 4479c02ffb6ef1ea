"""Silver and Gold builds composed from the operators."""
