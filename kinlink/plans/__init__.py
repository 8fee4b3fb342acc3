"""Whole steps of the pipeline: training, threshold sweep, scoring, export."""
