"""Analyses composed of operators, and the registry of queries."""
