"""Cohort-variant analytics as Spark DataFrame operators."""
