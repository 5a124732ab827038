"""Reusable DataFrame operators: dedupe, skew handling, upsert, history, checks."""
