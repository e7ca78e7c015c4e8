"""Operators of a training-data pipeline: counts, classifiers, near duplicates, scans and encodings over documents."""
