"""Matchbook: Spark jobs that turn fixed-width text reports into a star schema, metrics and reports."""
