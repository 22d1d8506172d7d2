"""Surveillance panel analytics as Spark DataFrame jobs."""
