"""End-to-end stages built from the operators."""
