"""Readers and writers for the text formats of variant work, as Spark jobs over lines."""
