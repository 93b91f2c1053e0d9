"""Data-pipeline operators as plain DataFrame functions for Spark."""

from millrace.session import local_session, prepare, scratch_path

__all__ = ["local_session", "prepare", "scratch_path"]
