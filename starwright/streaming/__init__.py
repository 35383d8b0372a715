"""Streaming: intentionally empty.

The reference is batch-only (no stream, watermark, window over event time,
state or late data anywhere), so there is no Structured Streaming operator to
match; every job in this package is a batch DataFrame job.
"""
