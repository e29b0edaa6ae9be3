"""Timed-transcript analytics as Spark DataFrame operators."""
