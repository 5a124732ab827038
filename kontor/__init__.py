"""Kontor: a shop's analytics warehouse as Spark jobs."""
