"""Spatio-temporal event-hazard analytics on Spark DataFrames."""

from tremorgrid.config import HazardConfig

__all__ = ["HazardConfig"]
