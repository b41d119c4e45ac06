"""Operators put together: cleaning, reports, evaluations."""
