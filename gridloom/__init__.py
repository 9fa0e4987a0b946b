"""Tidy monthly series from irregular statistical releases, on Spark."""

from gridloom.operators.clean import clean_flat, clean_index, clean_rate
from gridloom.plans.feeds import download_profile, run_all, run_flat, run_index, run_rate
from gridloom.sources.files import load_series, save_series

__all__ = ["clean_flat", "clean_index", "clean_rate", "download_profile", "load_series", "run_all", "run_flat", "run_index", "run_rate", "save_series"]
