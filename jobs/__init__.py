"""Runnable jobs: ``python -m jobs.cell_report --help``, ``python -m jobs.log_follow --help``."""
