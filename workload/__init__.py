"""Registered queries: each name maps to a Spark query and, where SQL can say it, its oracle."""
