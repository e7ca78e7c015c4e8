"""DataFrame -> DataFrame operators, each over all symbols at once."""
