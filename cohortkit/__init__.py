"""Cohorts, features, splits and train-fitted transforms on Spark."""

from cohortkit.plans import clean, health, run_protocol, train_ready
from cohortkit.session import build_session, scratch

__all__ = ["build_session", "clean", "health", "run_protocol", "scratch", "train_ready"]
__version__ = "0.1.0"
