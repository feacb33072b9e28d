"""Cleaning, marts, features, model, BI and table lifecycle jobs."""
