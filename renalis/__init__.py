"""Kidney-injury cohorts from common-data-model tables, as Spark DataFrame jobs."""

from renalis.config import PRESETS, CohortConfig, preset

__all__ = ["PRESETS", "CohortConfig", "preset"]
