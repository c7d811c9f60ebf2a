"""Cleaning, feature, profile, encoding and assembly operators."""
