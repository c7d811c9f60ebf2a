"""Registered queries and their independent SQL."""
