"""Spark-native refinement of clinical record exports: bronze, silver, checks, features."""

from chartmill.config import CleaningRules, Expectation, Layout
from chartmill.session import configure, scratch_dir

__all__ = ["CleaningRules", "Expectation", "Layout", "configure", "scratch_dir"]
