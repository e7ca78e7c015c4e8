"""Presets, the indicator registry, and the checked queries."""
