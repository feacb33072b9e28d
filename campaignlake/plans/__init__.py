"""Composite flows and the registered queries."""
