"""Relational steps of the jobs, each ``DataFrame -> DataFrame``."""
