"""Scans, landing zone, keyed tables and the sample-table adapters."""
