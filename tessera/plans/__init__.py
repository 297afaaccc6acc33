"""Whole runs: audit and publish, and the registered queries."""
