"""Whole jobs: ingest, training, evaluation, dashboards, scaling."""
