"""Structured Streaming jobs.

Every job writes its micro-batch to a directory named after the batch, so a
replayed batch replaces its own output and nothing is counted twice. The keyed
table is the log's newest row per key (``sources.storage.latest_from_log``).
"""
