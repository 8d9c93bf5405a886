"""Incremental, file-arrival driven runs of the daily jobs."""
