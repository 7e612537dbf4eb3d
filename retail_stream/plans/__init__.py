"""Whole batch pipelines, from messages to results."""
