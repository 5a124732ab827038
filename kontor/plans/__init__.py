"""Staging, dimensions, facts, metrics and quality suites as DataFrame functions."""
