"""Feeds and storage: message parsers, bar store, signal sink."""
