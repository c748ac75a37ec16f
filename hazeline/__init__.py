"""Hazeline: air-quality measurement analytics as Spark DataFrame jobs."""

from hazeline.session import build_session, tune, work_dir

__all__ = ["build_session", "tune", "work_dir"]
