"""Fixture views over the given tables, composed jobs and the query register."""
