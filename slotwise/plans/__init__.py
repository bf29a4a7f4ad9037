"""Compositions of operators: the two analysis chains, and the registered queries with their checks."""
