"""Relational operators: gate, checks, as-of, bars, roll, features, monitoring."""
