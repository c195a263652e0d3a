"""Composed jobs, the serving surface and the registered queries."""
