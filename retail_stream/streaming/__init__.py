"""Structured Streaming jobs: source, watermark, trigger and sink around the batch operators."""
