"""Market-data analytics as PySpark DataFrame operators.

Sub-packages: ``functions`` (Column expressions), ``sources`` (message parsers,
bar storage), ``operators`` (DataFrame -> DataFrame), ``streaming`` (Structured
Streaming jobs) and ``plans`` (presets, indicator registry, checked queries).
"""
