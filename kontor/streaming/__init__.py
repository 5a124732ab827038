"""Micro-batch refresh of the incremental facts."""
