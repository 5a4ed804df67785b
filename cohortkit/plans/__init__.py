"""Whole jobs made of operators."""

from cohortkit.plans.clean import CleanResult, clean
from cohortkit.plans.health import health
from cohortkit.plans.train_ready import TrainReady, run_protocol, train_ready

__all__ = ["CleanResult", "clean", "health", "TrainReady", "run_protocol", "train_ready"]
