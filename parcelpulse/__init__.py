"""Spectral-index time series per agricultural parcel, as Spark DataFrame plans."""

from parcelpulse.plans.rejected import rejected_cube, rejected_ndvi
from parcelpulse.plans.run import run_folders
from parcelpulse.plans.time_series import parcel_time_series

__all__ = ["parcel_time_series", "rejected_cube", "rejected_ndvi", "run_folders"]
